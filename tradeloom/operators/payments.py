"""The payment that stands for an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def payment_by_order(payments: DataFrame) -> DataFrame:
    """One method per order: a successful attempt first, then the earliest arrival.

    A partial aggregate, so an order with very many attempts never gathers in
    one task.
    """
    rank = F.struct(F.col("payment_status") != "SUCCESS", F.col("_raw_id"))
    return payments.groupBy("order_id").agg(F.min_by("payment_method", rank).alias("payment_method"))
