"""Warehouse constraints as counted violations, one row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom import contracts as C


def _check(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), F.col("violations").cast("bigint"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unique_violations(tables: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Keys that occur more than once, per (check name, table, key column)."""
    parts = []
    for name, df, key in tables:
        repeated = df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        parts.append(_check(repeated.agg(F.count("*").alias("violations")), name))
    return _union(parts)


def foreign_key_violations(links: list[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Non-null keys without a dimension row, per (check name, fact, dimension, key).

    The fact is reduced to its distinct keys first, so a hot key is one row.
    """
    parts = []
    for name, fact, dim, key in links:
        used = fact.select(key).dropna().groupBy(key).agg(F.count("*").alias("n"))
        orphans = used.join(dim.select(key), key, "left_anti")
        parts.append(_check(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")), name))
    return _union(parts)


def condition_violations(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows for which a condition is false; NULL passes, as in a CHECK constraint."""
    counts = df.agg(
        *[F.count_if(~F.coalesce(c, F.lit(True))).alias(n) for n, c in conditions.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("check_name"), F.col(n).cast("bigint").alias("violations"))
            for n in conditions
        ]
    )
    return counts.select(F.inline(rows))


def fact_sales_conditions() -> dict[str, Column]:
    """Quantity and amounts; profit may be negative, INR amounts may be missing."""
    amounts = ["unit_price", "gross_amount", "discount_amount", "net_amount", "cost_amount"]
    inr = [f"{n}_inr" for n in amounts[1:]]
    return {
        "quantity_positive": F.col("quantity") > 0,
        **{f"{n}_not_negative": F.col(n) >= 0 for n in amounts + inr},
    }


def fact_delivery_conditions() -> dict[str, Column]:
    names = ("delivery_distance_km", "delivery_time_minutes", "delivery_fee")
    return {f"{n}_not_negative": F.col(n) >= 0 for n in names}


def dimension_conditions() -> dict[str, dict[str, Column]]:
    return {
        "dim_product": {
            "unit_cost_not_negative": F.col("unit_cost") >= 0,
            "selling_price_not_negative": F.col("selling_price") >= 0,
            "product_rating_in_range": F.col("product_rating").between(0, 5),
        },
        "dim_store": {"store_type_allowed": F.col("store_type").isin(*C.STORE_TYPES)},
        "dim_currency": {"rate_positive": F.col("rate_to_inr") > 0},
        "dim_date": {
            "day_in_range": F.col("day_of_month").between(1, 31),
            "month_in_range": F.col("month_number").between(1, 12),
            "quarter_in_range": F.col("quarter_number").between(1, 4),
        },
    }


def run_conditions() -> dict[str, Column]:
    kinds = ("extracted", "validated", "rejected", "loaded")
    return {
        "status_allowed": F.col("status").isin(*C.RUN_STATUSES),
        **{f"records_{k}_not_negative": F.col(f"records_{k}") >= 0 for k in kinds},
        "quality_score_in_range": F.col("quality_score").between(0, 100),
    }


def dq_conditions() -> dict[str, Column]:
    return {
        "checked_not_negative": F.col("records_checked") >= 0,
        "failed_within_checked": F.col("records_failed").between(0, F.col("records_checked")),
        "failure_rate_in_range": F.col("failure_rate").between(0, 1),
    }


def require_types(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Refuse a frame whose columns are missing or of another type; never convert."""
    actual = dict(df.dtypes)
    for name, kind in expected.items():
        if name not in actual:
            raise TypeError(f"column {name} is missing; expected {kind}")
        if actual[name] != kind:
            raise TypeError(f"column {name} has type {actual[name]}; expected {kind}")
    return df


def add_missing_columns(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Additive schema upgrade: absent columns appear as typed NULLs."""
    absent = {n: F.lit(None).cast(t) for n, t in expected.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df
