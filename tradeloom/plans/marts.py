"""The seven reporting marts: a fact joined to one dimension, then aggregated.

All order statuses count.  Money is in INR.  Distinct orders are exact: Spark
deduplicates (group, order) pairs on their own shuffle key, so a group holding a
large share of the lines is still spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.functions.dates import year_month
from tradeloom.operators.joins import lookup_join

TOTAL = "decimal(24,2)"

SALES_MARTS: dict[str, tuple[str, str, tuple[str, ...]]] = {
    # mart: (dimension, join key, group columns)
    "monthly_sales": ("dim_date", "date_key", ("year", "month_number", "month_name")),
    "category_performance": ("dim_product", "product_key", ("category",)),
    "product_performance": (
        "dim_product",
        "product_key",
        ("product_id", "product_name", "category", "brand"),
    ),
    "store_performance": (
        "dim_store",
        "store_key",
        ("store_id", "store_name", "store_type", "country", "city"),
    ),
    "channel_performance": (
        "dim_channel",
        "channel_key",
        ("channel_code", "channel_name", "channel_group"),
    ),
    "customer_performance": (
        "dim_customer",
        "customer_key",
        ("customer_id", "first_name", "last_name", "country", "customer_segment"),
    ),
}

FACT_COLUMNS = ("source_order_id", "quantity", "net_amount_inr", "profit_amount_inr")


def _total(name: str) -> Column:
    return F.round(F.sum(name), 2).cast(TOTAL)


def sales_mart(name: str, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Sales, distinct orders, units and profit by one dimension's attributes."""
    dim_name, key, groups = SALES_MARTS[name]
    attributes = dims[dim_name].select(key, *[a for a in groups if a != key])
    return summarise_lines(name, lookup_join(fact.select(key, *FACT_COLUMNS), attributes, key))


def carried_name(dimension: str, attribute: str) -> str:
    """What an attribute is called on lines that carry several dimensions."""
    return f"{dimension}__{attribute}"


def carried(name: str) -> dict[str, tuple[str, ...]]:
    """The dimension attributes lines must carry for ``summarise_lines``."""
    dim_name, _, groups = SALES_MARTS[name]
    return {dim_name: groups}


def summarise_lines(name: str, lines: DataFrame) -> DataFrame:
    """The mart from lines that already carry the dimension's attributes."""
    groups = [
        F.col(a).alias("month") if a == "month_number" else F.col(a)
        for a in SALES_MARTS[name][2]
    ]
    return lines.groupBy(*groups).agg(
        _total("net_amount_inr").alias("sales"),
        F.count_distinct("source_order_id").alias("orders"),
        F.sum("quantity").cast("bigint").alias("units"),
        _total("profit_amount_inr").alias("profit"),
    )


#: Marts whose attributes an order has; the others' belong to the product of a line.
ORDER_MARTS = ("monthly_sales", "store_performance", "channel_performance", "customer_performance")
MEASURES = {"sales": "net_amount_inr", "units": "quantity", "profit": "profit_amount_inr"}


def carried_all(names: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """Per dimension the attributes that the marts group by."""
    wanted: dict[str, tuple[str, ...]] = {}
    for n in names:
        dim_name, _, groups = SALES_MARTS[n]
        wanted[dim_name] = tuple(dict.fromkeys((*wanted.get(dim_name, ()), *groups)))
    return wanted


def with_carried(dims: dict[str, DataFrame], names: Iterable[str]) -> tuple[dict[str, DataFrame], dict[str, tuple[str, ...]]]:
    """Dimensions with the marts' attributes under ``carried_name``, and the attributes for lines to carry."""
    wanted = carried_all(names)
    renamed = {
        d: dims[d].withColumns({carried_name(d, a): F.col(a) for a in attributes}) for d, attributes in wanted.items()
    }
    others = {d: dims[d] for d in dims if d not in renamed}
    return others | renamed, {d: tuple(carried_name(d, a) for a in attributes) for d, attributes in wanted.items()}


def _group(name: str) -> Column:
    """A mart's group columns as one struct, from lines that carry them as ``carried_name``."""
    dim_name, _, groups = SALES_MARTS[name]
    renamed = [F.col(carried_name(dim_name, a)).alias("month" if a == "month_number" else a) for a in groups]
    return F.struct(*renamed)


def all_sales_marts(lines: DataFrame, names: Iterable[str]) -> DataFrame:
    """Several marts from one pass over the lines: ``mart``, a struct of group columns named after each mart
    (null in the others' rows), and the four figures.

    First level: grouping sets of (order, what an order has) and (order, what a
    product has), so that every row below stands for one distinct order of its
    group.  Second level: those rows under each mart's own columns, where
    distinct orders are a plain count.  Both levels are partial aggregates, and
    a group with a third of all lines is spread by its orders.
    """
    names = list(names)
    groups = {n: f"_{n}" for n in names}
    lines = lines.select("source_order_id", *MEASURES.values(), *[_group(n).alias(groups[n]) for n in names])
    by_order = [groups[n] for n in names if n in ORDER_MARTS]
    # A product's category is one of its columns, but an order counts once for a category, whatever products it has of it.
    sets = [["source_order_id", *by_order]] if by_order else []
    sets += [["source_order_id", groups[n]] for n in names if n not in ORDER_MARTS]
    columns = ["source_order_id", *groups.values()]
    sums = [F.sum(c).alias(m) for m, c in MEASURES.items()]
    if len(sets) == 1:
        rows = lines.groupBy(*columns).agg(*sums).withColumn("_set", F.lit(0).cast("bigint"))
    else:
        wanted = [[F.col(c) for c in s] for s in sets]
        rows = lines.groupingSets(wanted, *[F.col(c) for c in columns]).agg(*sums, F.grouping_id().alias("_set"))
    # grouping_id has a bit for each column that a set leaves out, the first column's highest.
    bits = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    ids = [sum(bits[c] for c in columns if c not in s) if len(sets) > 1 else 0 for s in sets]
    kinds = {n: rows.schema[groups[n]].dataType for n in names}

    def row_of(name: str) -> Column:
        own = [F.col(groups[n]).alias(n) if n == name else F.lit(None).cast(kinds[n]).alias(n) for n in names]
        return F.struct(F.lit(name).alias("mart"), *own)

    found = [
        F.when(F.col("_set") == i, F.array(*[row_of(n) for n in names if groups[n] in s]))
        for i, s in zip(ids, sets, strict=True)
    ]
    spread = rows.withColumn("_row", F.explode(F.coalesce(*found))).select("_row.*", *MEASURES)
    return spread.groupBy("mart", *names).agg(
        F.round(F.sum("sales"), 2).cast(TOTAL).alias("sales"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("units").cast("bigint").alias("units"),
        F.round(F.sum("profit"), 2).cast(TOTAL).alias("profit"),
    )


def one_of(marts: DataFrame, name: str) -> DataFrame:
    """One mart's rows and columns out of ``all_sales_marts``."""
    return marts.where(F.col("mart") == name).select(f"{name}.*", "sales", "orders", "units", "profit")


def delivery_mart(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Delivery counts, averages and fees by type, status and channel group."""
    channels = dims["dim_channel"].select("channel_key", "channel_group")
    count = F.count("*")
    mean_km = F.sum("delivery_distance_km").cast("double") / count
    mean_minutes = F.sum("delivery_time_minutes").cast("double") / count
    return (
        lookup_join(fact, channels, "channel_key")
        .groupBy("delivery_type", "delivery_status", "channel_group")
        .agg(
            count.alias("deliveries"),
            F.round(mean_km, 2).alias("avg_distance_km"),
            F.round(mean_minutes, 2).alias("avg_time_minutes"),
            _total("delivery_fee").alias("total_delivery_fee"),
        )
    )


def with_year_month(monthly: DataFrame) -> DataFrame:
    """Monthly sales with its calculated label and sort columns."""
    return monthly.withColumns(
        {
            "year_month_sort": F.col("year") * 100 + F.col("month"),
            "year_month": year_month(F.col("year"), F.col("month")),
        }
    )
