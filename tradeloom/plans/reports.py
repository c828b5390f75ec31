"""Report queries: grouped measures with the report's own sort order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradeloom.functions.dates import hierarchy_columns
from tradeloom.functions.money import safe_divide
from tradeloom.plans import measures as M
from tradeloom.plans.marts import TOTAL, with_year_month
from tradeloom.session import cut_lineage


def top_n(rows: DataFrame, value: str, n: int, tie_break: list[str]) -> DataFrame:
    """The n highest rows, with every row tied to the n-th.

    The rows are written once.  The n-th value is found from each task's own top
    n and becomes a threshold, so however many rows tie with it, they never
    gather in one task.
    """
    rows = cut_lineage(rows, "ranked")
    threshold = rows.select(value).orderBy(F.desc(value)).limit(n).agg(F.min(value)).scalar()
    return rows.filter(F.col(value) >= threshold).orderBy(F.desc(value), *tie_break)


def ranked(rows: DataFrame, value: str, *tie_break: str) -> DataFrame:
    return rows.orderBy(F.desc(value), *tie_break)


def revenue_trend(monthly: DataFrame) -> DataFrame:
    labelled = with_year_month(monthly)
    return M.summarise(
        labelled,
        {"total_revenue": M.money_total("sales")},
        ["year_month", "year_month_sort", "year", "month", "month_name"],
    ).orderBy("year_month_sort")


def revenue_by_year(monthly: DataFrame, where: Column | None = None) -> DataFrame:
    return M.summarise(monthly, {"total_revenue": M.money_total("sales")}, ["year"], where).orderBy("year")


def sales_with_share(mart: DataFrame, by: str, many: bool = False) -> DataFrame:
    """Sales and profit by one attribute with revenue share and margin, best first.

    The groups add up to the whole, so the mart is evaluated once.  Where they
    are ``many``, they are written and their total is read from there, so that
    they never gather in one task.
    """
    groups = M.summarise(
        mart,
        {"sales": M.money_total("sales"), "profit": M.money_total("profit"), "profit_margin": M.margin()},
        [by],
    )
    if many:
        groups = cut_lineage(groups, "groups")
        whole = groups.agg(F.sum("sales").cast(TOTAL).alias("whole")).scalar()
    else:
        whole = F.sum("sales").over(W.partitionBy()).cast(TOTAL)
    return ranked(
        groups.withColumn("revenue_share", safe_divide(F.col("sales"), whole)), "sales", by
    )


def sales_and_profit(mart: DataFrame, by: str) -> DataFrame:
    groups = M.summarise(mart, {"sales": M.money_total("sales"), "profit": M.money_total("profit")}, [by])
    return ranked(groups, "sales", by)


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    """Best product names (names, not ids) with share of all sales and margin."""
    return top_n(sales_with_share(products, "product_name", many=True), "sales", n, ["product_name"])


def segments(customers: DataFrame) -> DataFrame:
    groups = M.summarise(
        customers,
        {"customer_revenue": M.money_total("sales"), "customer_profit": M.money_total("profit")},
        ["customer_segment"],
    )
    whole = F.sum("customer_revenue").over(W.partitionBy())  # at most five segments
    return ranked(
        groups.withColumn("segment_share", safe_divide(F.col("customer_revenue"), whole)),
        "customer_revenue",
        "customer_segment",
    )


def top_customers(customers: DataFrame, n: int = 15) -> DataFrame:
    """Best customers by id, shown by name, country and segment."""
    best = top_n(customers, "sales", n, ["customer_id"])
    shown = best.groupBy("first_name", "last_name", "country", "customer_segment").agg(
        M.count_total("orders").alias("orders"),
        M.count_total("units").alias("units"),
        M.money_total("sales").alias("sales"),
        M.money_total("profit").alias("profit"),
    )
    return ranked(shown, "sales", "last_name", "first_name")


def top_stores(stores: DataFrame, n: int = 10) -> DataFrame:
    """Best stores by id, shown by name with city and country."""
    best = top_n(stores, "sales", n, ["store_id"])
    shown = best.groupBy("store_name", "city", "country").agg(
        M.money_total("sales").alias("store_revenue")
    )
    return ranked(shown, "store_revenue", "store_name")


def store_types(stores: DataFrame) -> DataFrame:
    groups = M.summarise(
        stores,
        {"store_revenue": M.money_total("sales"), "store_profit": M.money_total("profit")},
        ["store_type"],
    )
    return ranked(groups, "store_revenue", "store_type")


def delivery_status(deliveries: DataFrame) -> DataFrame:
    shares = M.share_within(
        deliveries, ["delivery_status"], "delivery_status", "deliveries", "status_share", "bigint"
    )
    return ranked(shares, "deliveries", "delivery_status")


def delivery_types(deliveries: DataFrame) -> DataFrame:
    groups = M.summarise(deliveries, {"deliveries": M.count_total("deliveries")}, ["delivery_type"])
    return ranked(groups, "deliveries", "delivery_type")


def delivery_matrix(deliveries: DataFrame) -> DataFrame:
    by = ["delivery_type", "delivery_status", "channel_group"]
    groups = M.summarise(
        deliveries,
        {**M.delivery(), "total_delivery_fee": F.sum("total_delivery_fee").cast(TOTAL)},
        by,
    )
    return ranked(groups, "total_deliveries", *by)


def runs_by_status(runs: DataFrame) -> DataFrame:
    groups = runs.groupBy("status").agg(F.count("*").alias("total_pipeline_runs"))
    return ranked(groups, "total_pipeline_runs", "status")


def dq_by_table(results: DataFrame) -> DataFrame:
    groups = M.summarise(results, M.data_quality(), ["table_name"])
    return ranked(groups, "records_checked", "table_name")


def dq_by_rule(results: DataFrame) -> DataFrame:
    groups = M.summarise(results, M.data_quality(), ["table_name", "rule_name"])
    return ranked(groups, "records_failed", "table_name", "rule_name")


def dq_of_runs(results: DataFrame, runs: DataFrame, where: Column) -> DataFrame:
    """Results of the runs a filter keeps; the filter flows from runs to results only."""
    kept = runs.filter(where).select("run_id")
    return dq_by_table(results.join(kept, "run_id", "left_semi"))


def run_log(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id")


def padded_calendar(rows: DataFrame, ts: str) -> DataFrame:
    """Every day from January 1 of the first year to December 31 of the last."""
    years = rows.agg(F.year(F.min(ts)).alias("first"), F.year(F.max(ts)).alias("last"))
    days = F.sequence(F.make_date("first", F.lit(1), F.lit(1)), F.make_date("last", F.lit(12), F.lit(31)))
    return (
        years.select(F.explode(days).alias("date"))
        .select("date", *hierarchy_columns(F.col("date")))
    )


def by_date_hierarchy(rows: DataFrame, ts: str, name: str) -> DataFrame:
    """Row counts per calendar day, empty days included.

    Rows are counted per day first, so the join to the calendar sees days only.
    """
    per_day = rows.groupBy(F.to_date(ts).alias("date")).agg(F.count("*").alias(name))
    return (
        padded_calendar(rows, ts)
        .join(per_day, "date", "left")
        .withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))
    )


def slicer_values(sources: list[tuple[DataFrame, dict[str, tuple[str, Column | None]]]]) -> DataFrame:
    """Distinct values of report filters as (slicer, value) rows.

    Each source names its slicers' columns, and for a frame of several marts the
    rows that have them; it is read once for all of them.
    """
    parts = []
    for frame, slicers in sources:
        entries = []
        for name, (c, rows) in slicers.items():
            entry = F.struct(F.lit(name).alias("slicer"), F.col(c).cast("string").alias("value"))
            entries.append(entry if rows is None else F.when(rows, entry))
        found = frame.select(F.explode(F.array_compact(F.array(*entries))).alias("_entry"))
        parts.append(found.select("_entry.*").distinct())
    return reduce(DataFrame.unionByName, parts)
