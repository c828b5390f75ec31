"""Exchange rates: one rate per currency and day, and their attachment to orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tradeloom.contracts import BASE_CURRENCY, CURRENCY_CODES, RATE
from tradeloom.operators.joins import lookup_join


def daily_rates(rates: DataFrame) -> DataFrame:
    """Usable rates, the last arrival winning within a currency and day."""
    return (
        rates.dropna(subset=["currency_code", "rate_date", "rate_to_inr"])
        .groupBy("currency_code", "rate_date")
        .agg(F.max_by("rate_to_inr", "_raw_id").cast(RATE).alias("rate_to_inr"))
    )


def latest_rates(daily: DataFrame) -> DataFrame:
    """The most recent rate of each currency."""
    return daily.groupBy("currency_code").agg(
        F.max_by("rate_to_inr", "rate_date").alias("latest_rate"),
        F.max("rate_date").alias("latest_date"),
    )


def asof_rates(asked: DataFrame, daily: DataFrame, currency: str, day: str) -> DataFrame:
    """For each distinct currency and day of ``asked`` the last quote on or before it, if there is one.

    Asked days and quotes are united and put in order per currency and year; a
    day takes the last quote before it in its year, or else the last one of the
    years before.  So a gap between two quotes costs nothing, however long, and
    a window sees one year of one currency.
    """
    days = asked.select(F.col(currency).alias("_code"), F.col(day).alias("_day")).dropna().distinct()
    quotes = daily.select(F.col("currency_code").alias("_code"), F.col("rate_date").alias("_day"), F.col("rate_to_inr").alias("_quote"))
    both = quotes.withColumn("_asked", F.lit(False)).unionByName(
        days.withColumns({"_quote": F.lit(None).cast(RATE), "_asked": F.lit(True)})
    )
    both = both.withColumn("_year", F.year("_day"))
    in_year = W.partitionBy("_code", "_year").orderBy("_day", "_asked").rowsBetween(W.unboundedPreceding, 0)
    placed = both.withColumn("_within", F.last("_quote", ignorenulls=True).over(in_year)).where("_asked")
    # The last quote of each year with one, carried over the years up to the next such one.
    ends = quotes.groupBy("_code", F.year("_day").alias("_year")).agg(F.max_by("_quote", "_day").alias("_end"))
    years = placed.where(F.col("_within").isNull()).select("_code", "_year").distinct()
    years = years.withColumn("_end", F.lit(None).cast(RATE)).unionByName(ends)
    earlier = W.partitionBy("_code").orderBy("_year").rangeBetween(W.unboundedPreceding, -1)
    carried = years.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier))
    carried = carried.groupBy("_code", "_year").agg(F.max("_before").alias("_before"))
    found = placed.join(carried, ["_code", "_year"], "left")
    return found.select(
        F.col("_code").alias(currency), F.col("_day").alias(day), F.coalesce("_within", "_before").alias("rate_to_inr")
    )


def attach_rates(
    frame: DataFrame,
    rates: DataFrame,
    currency: str = "currency",
    day: str = "order_date",
    fallback: str = "latest",
) -> DataFrame:
    """Add ``fx_rate`` by currency and day.

    ``latest``: the day's rate, else the currency's most recent one, even if
    that is later than the day.  ``asof``: the most recent rate on or before
    the day.  Both are equality joins to one row per currency and day; the base
    currency defaults to 1.
    """
    daily = daily_rates(rates)
    base = F.when(F.col(currency) == BASE_CURRENCY, F.lit(1).cast(RATE))
    if fallback == "asof":
        found = asof_rates(frame, daily, currency, day).withColumnRenamed("rate_to_inr", "_exact")
        # A row per currency and day that occur: whether that is small Spark sees when it has them.
        joined = frame.join(found, [currency, day], "left")
        return joined.withColumn("fx_rate", F.coalesce("_exact", base)).drop("_exact")
    exact = daily.select(
        F.col("currency_code").alias(currency),
        F.col("rate_date").alias(day),
        F.col("rate_to_inr").alias("_exact"),
    )
    # One row per allowed code: a dozen rows whatever the feed holds, so always broadcast.
    allowed = daily.filter(F.col("currency_code").isin(*CURRENCY_CODES))
    latest = F.broadcast(latest_rates(allowed).withColumnRenamed("currency_code", currency))
    joined = lookup_join(frame, exact, [currency, day], "left").join(latest, currency, "left")
    return joined.withColumn("fx_rate", F.coalesce("_exact", "latest_rate", base)).drop(
        "_exact", "latest_rate", "latest_date"
    )
