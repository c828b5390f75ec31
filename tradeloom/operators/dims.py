"""Dimension builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom import contracts as C
from tradeloom.functions.dates import calendar_columns
from tradeloom.operators.fx import daily_rates, latest_rates
from tradeloom.operators.keys import dense_keys
from tradeloom.operators.merge import insert_if_absent, update_only, upsert

DIM_KEYS = {
    "dim_customer": ("customers", "customer_id", "customer_key"),
    "dim_product": ("products", "product_id", "product_key"),
    "dim_store": ("stores", "store_id", "store_key"),
}


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """The earliest arrival of each key, whole row, as a partial aggregate."""
    rest = [c for c in df.columns if c not in (key, "_raw_id")]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col("_raw_id")).alias("_row"))
    return first.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def contract_columns(table: str) -> list[Column]:
    """A source table's columns cast to their load types."""
    return [F.col(n).cast(t).alias(n) for n, t in C.SOURCE_SCHEMAS[table].items()]


def dimension(table: str, rows: DataFrame, unique: bool = False) -> DataFrame:
    """A business dimension from typed rows.

    ``unique`` skips the first-per-key step for rows that already passed the
    duplicate rule.
    """
    key = next(k for t, k, _ in DIM_KEYS.values() if t == table)
    deduplicated = rows if unique else first_per_key(rows, key)
    return deduplicated.select(*contract_columns(table))


def keyed_dimension(name: str, valid: dict[str, DataFrame]) -> DataFrame:
    """A business dimension with dense keys from 1, as on a first load."""
    table, business, surrogate = DIM_KEYS[name]
    return dense_keys(dimension(table, valid[table], unique=True), business, surrogate)


def naturally_keyed_dimension(name: str, valid: dict[str, DataFrame]) -> DataFrame:
    """The same dimension keyed by its business id.

    For marts computed straight from the sources: the star joins are the same,
    the numbering step is not needed.
    """
    table, business, surrogate = DIM_KEYS[name]
    rows = dimension(table, valid[table], unique=True)
    return rows.withColumn(surrogate, F.col(business))


def seed_rows(spark: SparkSession, rows: tuple, schema: str) -> DataFrame:
    """A seeded dimension as a local relation."""
    names = [part.split()[0] for part in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    typed = [F.col(part.split()[0]).cast(part.split()[1]) for part in schema.split(", ")]
    return spark.range(1).select(F.inline(F.array(*structs))).select(*typed)


def dim_channel(spark: SparkSession) -> DataFrame:
    return seed_rows(spark, C.CHANNELS, C.CHANNEL_SCHEMA)


def dim_currency(spark: SparkSession) -> DataFrame:
    return seed_rows(spark, C.CURRENCIES, C.CURRENCY_SCHEMA)


def dim_payment_method(spark: SparkSession) -> DataFrame:
    return seed_rows(spark, C.PAYMENT_METHODS, C.PAYMENT_METHOD_SCHEMA)


def code_key(code: Column, rows: tuple) -> Column:
    """Surrogate key of a seeded code as a literal map lookup; unknown codes give NULL."""
    entries = [F.lit(v) for row in rows for v in (row[1], row[0])]
    return F.element_at(F.create_map(*entries), code)


def refresh_currency_rates(currencies: DataFrame, rates: DataFrame) -> DataFrame:
    """Seeded currencies with the latest rate; codes without one keep theirs."""
    latest = latest_rates(daily_rates(rates)).withColumn("rate_to_inr", F.col("latest_rate").cast(C.RATE))
    return update_only(currencies, latest, "currency_code", "rate_to_inr")


def calendar_seed(spark: SparkSession) -> DataFrame:
    """One row per day of the seeded calendar."""
    first = F.lit(C.CALENDAR_FIRST_DAY).cast("date")
    last = F.lit(C.CALENDAR_LAST_DAY).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def dates_in_data(valid: dict[str, DataFrame]) -> DataFrame:
    """Distinct calendar days of the five source date columns.

    Each source is reduced to its days before the union, so the final distinct
    only sees calendars.
    """
    columns = (
        ("customers", "signup_date"),
        ("stores", "opening_date"),
        ("orders", "order_date"),
        ("payments", "payment_date"),
        ("exchange_rates", "rate_date"),
    )
    per_source = [
        valid[t].select(F.col(c).cast("date").alias("d")).dropna().distinct() for t, c in columns
    ]
    return reduce(DataFrame.unionByName, per_source).distinct().select(
        *calendar_columns(F.col("d"))
    )


def dim_date(spark: SparkSession, valid: dict[str, DataFrame]) -> DataFrame:
    """Seeded calendar with the data's days merged in."""
    return upsert(calendar_seed(spark), dates_in_data(valid), "date_key")


def seeded(current: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Seed rows join a dimension only where their key is absent."""
    return insert_if_absent(current, seed, key)
