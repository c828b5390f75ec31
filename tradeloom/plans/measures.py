"""Business measures over marts.

A measure is an aggregate expression; ``summarise`` evaluates a set of them
over a mart, optionally grouped and filtered.  Marts are unrelated to each
other: a filter only reaches the mart it names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradeloom.functions.dates import seconds_between
from tradeloom.functions.money import safe_divide
from tradeloom.plans.marts import TOTAL
from tradeloom.session import cut_lineage

Measures = dict[str, Column]


#: What a measure calls a mart's column: the column itself, or its values in the rows of one mart among several.
Of = Callable[[str], Column]


def within(name: str) -> Of:
    """Columns of one mart in ``marts.all_sales_marts``; null in the rows of the others."""
    own = F.col("mart") == name
    figures = ("sales", "orders", "units", "profit")
    return lambda c: F.when(own, F.col(c)) if c in figures else F.col(f"{name}.{c}")


def money_total(name: str, of: Of = F.col) -> Column:
    return F.sum(of(name)).cast(TOTAL)


def count_total(name: str, of: Of = F.col) -> Column:
    return F.sum(of(name)).cast("bigint")


def executive(of: Of = F.col) -> Measures:
    sales, profit, orders = money_total("sales", of), money_total("profit", of), count_total("orders", of)
    return {
        "total_revenue": sales,
        "total_profit": profit,
        "total_orders": orders,
        "units_sold": count_total("units", of),
        "profit_margin": safe_divide(profit, sales),
        "average_order_value": safe_divide(sales, orders),
    }


def customer(of: Of = F.col) -> Measures:
    customers = F.count_distinct(of("customer_id"))
    return {
        "purchasing_customers": customers,
        "customer_revenue": money_total("sales", of),
        "customer_profit": money_total("profit", of),
        "customer_orders": count_total("orders", of),
        "revenue_per_customer": safe_divide(money_total("sales", of), customers),
    }


def store(of: Of = F.col) -> Measures:
    return {
        "store_revenue": money_total("sales", of),
        "store_profit": money_total("profit", of),
        "store_orders": count_total("orders", of),
    }


def _weighted(average: str) -> Column:
    """Mean of the mart's rounded averages, weighted by deliveries, in exact decimals."""
    mean = F.col(average).cast("decimal(14,2)")
    weighted = F.sum((mean * F.col("deliveries").cast("decimal(18,0)")).cast("decimal(33,2)"))
    return safe_divide(weighted, F.sum("deliveries"))


def delivery() -> Measures:
    return {
        "total_deliveries": count_total("deliveries"),
        "average_delivery_minutes": _weighted("avg_time_minutes"),
        "average_delivery_km": _weighted("avg_distance_km"),
    }


def margin() -> Column:
    return safe_divide(money_total("profit"), money_total("sales"))


def run_records() -> Measures:
    return {
        f"records_{kind}": count_total(f"records_{kind}")
        for kind in ("extracted", "validated", "rejected", "loaded")
    }


def data_quality() -> Measures:
    """Sums over all result rows.

    A table's overall row sits next to its rule rows, so ``records_checked``
    counts a table once per stored row; that is the measure's definition.
    """
    return {
        "records_checked": count_total("records_checked"),
        "records_failed": count_total("records_failed"),
        "failure_rate": safe_divide(F.sum("records_failed"), F.sum("records_checked")),
    }


def summarise(
    mart: DataFrame, measures: Measures, by: list[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Evaluate measures over a mart, one row or one row per group."""
    rows = mart if where is None else mart.filter(where)
    return rows.groupBy(*(by or [])).agg(*[c.alias(n) for n, c in measures.items()])


def share_of_all(
    mart: DataFrame, by: list[str], value: str, name: str, where: Column | None = None
) -> DataFrame:
    """Group totals and their share of the whole mart, whatever ``where`` keeps.

    The mart is written and the total is a scalar subquery over it, so neither a
    second evaluation, a cross join nor a one-task window is needed.
    """
    mart = cut_lineage(mart.select(*by, value) if where is None else mart, "mart")
    whole = mart.agg(money_total(value)).scalar()
    groups = summarise(mart, {value: money_total(value)}, by, where)
    return groups.withColumn(name, safe_divide(F.col(value), whole))


def share_within(
    rows: DataFrame, by: list[str], freed: str, value: str, name: str, kind: str = TOTAL
) -> DataFrame:
    """Share of each group with one column's filter removed.

    Sums are grouped first; the window then spans the values of ``freed``
    only, a code set of a few members.
    """
    others = [c for c in by if c != freed]
    groups = rows.groupBy(*by).agg(F.sum(value).cast(kind).alias(value))
    whole = F.sum(value).over(W.partitionBy(*others))
    return groups.withColumn(name, safe_divide(F.col(value), whole))


def run_counts_by_status(runs: DataFrame) -> DataFrame:
    """Run counts as seen under each status filter.

    The total obeys the filter; successful and failed runs replace it, so they
    read the same under every status.  The window spans at most four rows.
    """
    by_status = runs.groupBy("status").agg(F.count("*").alias("total_pipeline_runs"))
    everything = W.partitionBy()

    def count_of(status: str) -> Column:
        matching = F.when(F.col("status") == status, F.col("total_pipeline_runs"))
        return F.coalesce(F.sum(matching).over(everything), F.lit(0)).cast("bigint")

    return by_status.select(
        "status",
        "total_pipeline_runs",
        count_of("SUCCESS").alias("successful_runs"),
        count_of("FAILED").alias("failed_runs"),
    )


def average_duration(runs: DataFrame) -> DataFrame:
    """Mean whole seconds of the runs that have both ends."""
    seconds = seconds_between(F.col("started_at"), F.col("completed_at"))
    return runs.agg(
        (F.sum(seconds).cast("double") / F.count(seconds)).alias("average_duration_seconds")
    )


def latest_quality(runs: DataFrame) -> DataFrame:
    """Score of the completed run that started last, whatever filters are set."""
    order = F.struct("started_at", "run_id")
    done = F.col("completed_at").isNotNull()
    return runs.filter(done).agg(F.max_by("quality_score", order).alias("latest_quality_score"))


#: The marts that the summary reads.
BUNDLED = ("monthly_sales", "customer_performance", "store_performance")


def bundle(sales_marts: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The saved one-row summary of fourteen measures from four unrelated marts.

    ``sales_marts`` holds the three of ``BUNDLED`` as ``marts.all_sales_marts``
    does; their measures are taken in one aggregate.
    """
    customers, stores = customer(within("customer_performance")), store(within("store_performance"))
    chosen = executive(within("monthly_sales"))
    chosen |= {n: customers[n] for n in ("purchasing_customers", "customer_revenue", "customer_profit")}
    chosen |= {n: stores[n] for n in ("store_revenue", "store_profit")}
    names = ("total_deliveries", "average_delivery_minutes", "average_delivery_km")
    packed = summarise(deliveries, {n: delivery()[n] for n in names}).select(F.struct(*names))
    row = summarise(sales_marts, chosen).withColumn("_d", packed.scalar())
    return row.withColumns({n: F.col(f"_d.{n}") for n in names}).drop("_d")


def margins(sales_marts: DataFrame, members: dict[str, str]) -> DataFrame:
    """Profit margin per (mart, member) of marts held by one frame; ``members`` names each mart's column."""
    member = F.coalesce(*[F.col(f"{mart}.{c}").cast("string") for mart, c in members.items()])
    return summarise(sales_marts.withColumn("member", member), {"profit_margin": margin()}, ["mart", "member"])
