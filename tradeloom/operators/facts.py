"""Fact builders.

Everything an order line inherits from its order (customer, store, channel,
currency, rate, payment) is resolved at order grain first.  The lines are then
joined once to their finished order header and once to their product; the order
join comes last, so what follows finds the lines partitioned by order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom import contracts as C
from tradeloom.functions.dates import date_key
from tradeloom.operators.amounts import with_inr_amounts, with_line_amounts
from tradeloom.operators.dims import code_key
from tradeloom.operators.fx import attach_rates
from tradeloom.operators.joins import lookup_join
from tradeloom.operators.payments import payment_by_order


# Dimension -> (business key, surrogate key) of the joins at order grain.
HEADER_DIMENSIONS = {
    "dim_customer": ("customer_id", "customer_key"),
    "dim_store": ("store_id", "store_key"),
    "dim_date": ("date_key", "date_key"),
    "dim_channel": ("channel_key", "channel_key"),
}
Carry = dict[str, tuple[str, ...]]


def _dimension_columns(name: str, required: tuple[str, ...], carry: Carry) -> list[str]:
    """Join columns plus the carried attributes, each once."""
    return list(dict.fromkeys((*required, *carry.get(name, ()))))


def order_headers(
    valid: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    fallback: str = "latest",
    with_payment: bool = True,
    carry: Carry | None = None,
) -> DataFrame:
    """Orders with their keys, rate and payment; orders lacking a key are dropped.

    ``carry`` names dimension attributes to bring along, so that a report over
    them needs no second join to the same dimension.
    """
    carry = carry or {}
    orders = valid["orders"].select(
        "order_id",
        "customer_id",
        "store_id",
        "order_date",
        "sales_channel",
        "order_status",
        "currency",
    )
    headers = orders.select(
        "*",
        date_key(F.col("order_date")).alias("date_key"),
        code_key(F.col("sales_channel"), C.CHANNELS).alias("channel_key"),
        code_key(F.col("currency"), C.CURRENCIES).alias("currency_key"),
    ).dropna(subset=["date_key", "channel_key", "currency_key"])
    for name, (business, surrogate) in HEADER_DIMENSIONS.items():
        if name in carry or business != surrogate:
            columns = _dimension_columns(name, (business, surrogate), carry)
            headers = lookup_join(headers, dims[name].select(*columns), business)
    headers = attach_rates(headers, valid["exchange_rates"], fallback=fallback)
    if with_payment:
        headers = lookup_join(headers, payment_by_order(valid["payments"]), "order_id", "left")
        headers = headers.withColumn(
            "payment_method_key", code_key(F.col("payment_method"), C.PAYMENT_METHODS)
        )
    return headers


def sales_lines(
    valid: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    fallback: str = "latest",
    with_payment: bool = True,
    carry: Carry | None = None,
) -> DataFrame:
    """Order lines with keys and amounts, before the load projection.

    ``with_payment=False`` leaves out the payment join, which never adds or
    drops lines, for callers that do not read the payment method.  Lines that carry
    their product's id are grouped by it, so they meet their product last.
    """
    carry = carry or {}
    headers = order_headers(valid, dims, fallback, with_payment, carry)
    required = ("product_id", "product_key", "unit_cost")
    products = dims["dim_product"].select(*_dimension_columns("dim_product", required, carry))
    items = valid["order_items"].select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent"
    )
    sides = [(products, "product_id"), (headers, "order_id")]
    if "product_id" in carry.get("dim_product", ()):
        sides.reverse()
    lines = items
    for side, key in sides:
        lines = lookup_join(lines, side, key)
    return (
        with_inr_amounts(with_line_amounts(lines))
        .withColumnRenamed("order_id", "source_order_id")
        .withColumnRenamed("order_item_id", "source_order_item_id")
    )


def fact_sales(
    valid: dict[str, DataFrame], dims: dict[str, DataFrame], fallback: str = "latest"
) -> DataFrame:
    """The sales fact's load columns: one row per order line, no order total."""
    lines = sales_lines(valid, dims, fallback)
    return lines.select(*[F.col(n).cast(t).alias(n) for n, t in C.FACT_SALES_SCHEMA.items()])


def delivery_events(valid: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Deliveries with keys; the store is the delivery's, date and channel the order's."""
    orders = valid["orders"].select("order_id", "customer_id", "sales_channel", "order_date")
    orders = lookup_join(
        orders, dims["dim_customer"].select("customer_id", "customer_key"), "customer_id"
    )
    events = lookup_join(
        valid["deliveries"], dims["dim_store"].select("store_id", "store_key"), "store_id"
    )
    joined = lookup_join(events, orders, "order_id")
    return joined.select(
        date_key(F.col("order_date")).alias("date_key"),
        "customer_key",
        "store_key",
        code_key(F.col("sales_channel"), C.CHANNELS).alias("channel_key"),
        F.col("order_id").alias("source_order_id"),
        "delivery_id",
        "delivery_type",
        "delivery_status",
        F.bround("delivery_distance_km", 2).cast("decimal(10,2)").alias("delivery_distance_km"),
        F.bround("delivery_time_minutes", 0).cast("int").alias("delivery_time_minutes"),
        F.bround("delivery_fee", 2).cast(C.MONEY).alias("delivery_fee"),
    ).dropna(subset=["date_key", "channel_key", "delivery_time_minutes"])


def fact_delivery(valid: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """The delivery fact's load columns: one row per delivery event."""
    events = delivery_events(valid, dims)
    return events.select(*[F.col(n).cast(t).alias(n) for n, t in C.FACT_DELIVERY_SCHEMA.items()])
