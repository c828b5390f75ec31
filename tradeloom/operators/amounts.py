"""Line amounts in the transaction currency and their INR equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.contracts import AMOUNT, MONEY
from tradeloom.functions.money import percent_of, to_amount

LINE_AMOUNTS = ("gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount")
INR_SOURCES = ("unit_price", *LINE_AMOUNTS)


def with_line_amounts(lines: DataFrame) -> DataFrame:
    """Add the five line amounts from quantity, unit_price, discount_percent, unit_cost.

    Gross uses the unrounded unit price; the stored unit price is rounded after.
    A missing discount or cost counts as zero.  Every amount is rounded half to
    even before the next one is derived from it.
    """
    zero = F.lit(0).cast(MONEY)
    quantity = F.col("quantity").cast("decimal(10,0)")
    discount_percent = F.coalesce("discount_percent", zero)
    unit_cost = F.coalesce("unit_cost", zero)
    return (
        lines.withColumns(
            {
                "gross_amount": to_amount(quantity * F.col("unit_price")),
                "cost_amount": to_amount(quantity * unit_cost),
                "unit_price": F.bround("unit_price", 2).cast(MONEY),
            }
        )
        .withColumn(
            "discount_amount", to_amount(percent_of(F.col("gross_amount"), discount_percent))
        )
        .withColumn("net_amount", (F.col("gross_amount") - F.col("discount_amount")).cast(AMOUNT))
        .withColumn("profit_amount", (F.col("net_amount") - F.col("cost_amount")).cast(AMOUNT))
    )


def with_inr_amounts(lines: DataFrame, rate: str = "fx_rate") -> DataFrame:
    """Add ``<amount>_inr`` columns; each is converted and rounded on its own."""
    return lines.withColumns(
        {f"{name}_inr": to_amount(F.col(name) * F.col(rate)) for name in INR_SOURCES}
    )


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per order: sum of quantity * price * (1 - discount %), 0 without lines.

    Lines are summed at twelve places, exact for prices of eight digits behind
    the point and discounts of two, and rounded once.
    """
    share = F.lit(100).cast("decimal(3,0)") - F.col("discount_percent").cast("decimal(7,4)")
    price = F.col("unit_price").cast("decimal(20,10)")
    line = percent_of((F.col("quantity").cast("decimal(10,0)") * price).cast("decimal(24,10)"), share)
    totals = items.groupBy("order_id").agg(
        F.bround(F.sum(line.cast("decimal(28,12)")), 2).cast(AMOUNT).alias("order_total")
    )
    return orders.drop("order_total").join(totals, "order_id", "left").withColumn(
        "order_total", F.coalesce("order_total", F.lit(0).cast(AMOUNT))
    )
