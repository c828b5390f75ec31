"""The record-level rules of each source table, declared as data.

A table's specification says which columns are free text, codes, numbers and
dates, which columns identify a record, and which columns point at a parent
table.  Rules are boolean columns over the normalised row; their order is
their precedence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from tradeloom import contracts as C

HitMap = dict[str, Column]


@dataclass(frozen=True)
class TableSpec:
    """How one source table is normalised, identified and checked."""

    name: str
    key: tuple[str, ...]
    checks: Callable[[], HitMap]
    text: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    parents: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(C.SOURCE_SCHEMAS[self.name])

    def rules(self) -> list["Rule"]:
        """The catalogue's rules in order, each bound to its condition."""
        hits = self.checks()
        return [
            Rule(name, reason, F.coalesce(hits[name], F.lit(False)))
            for name, reason in C.RULE_REASONS[self.name].items()
        ]


@dataclass(frozen=True)
class Rule:
    """A named condition that is true for a bad record."""

    name: str
    reason: str
    hit: Column


DUPLICATE = "_duplicate"


def known(parent_column: str) -> str:
    """Marker column: the value exists among the valid parent rows."""
    return f"_known_{parent_column}"


def _col(name: str) -> Column:
    return F.col(name)


def _missing(name: str) -> Column:
    return _col(name) == ""  # normalised text is never NULL


def _not_in(name: str, codes: tuple[str, ...]) -> Column:
    return ~_col(name).isin(*codes)


def _outside(name: str, low: float | None = None, high: float | None = None) -> Column:
    """Not a number, or not within the closed range."""
    c = _col(name)
    bad = c.isNull()
    if low is not None:
        bad = bad | (c < F.lit(low))
    if high is not None:
        bad = bad | (c > F.lit(high))
    return bad


def _duplicated() -> Column:
    return _col(DUPLICATE)


def _orphan(name: str) -> Column:
    return _col(known(name)).isNull()


def _customers() -> HitMap:
    return {
        "required_customer_id": _missing("customer_id"),
        "duplicate_customer_id": _duplicated(),
        "required_email": _missing("email"),
        "invalid_email_format": ~_missing("email") & ~_col("email").contains("@"),
        "invalid_signup_date": _col("signup_date").isNull(),
        "invalid_customer_segment": _not_in("customer_segment", C.CUSTOMER_SEGMENTS),
    }


def _products() -> HitMap:
    cost, price = _col("unit_cost"), _col("selling_price")
    return {
        "required_product_id": _missing("product_id"),
        "duplicate_product_id": _duplicated(),
        "required_product_name": _missing("product_name"),
        "required_category": _missing("category"),
        "invalid_unit_cost": cost.isNull(),
        "invalid_selling_price": price.isNull(),
        "negative_unit_cost": cost < 0,
        "negative_selling_price": price < 0,
        "unit_cost_exceeds_selling_price": cost > price,
        "invalid_product_rating": _outside("product_rating", 0, 5),
    }


def _stores() -> HitMap:
    return {
        "required_store_id": _missing("store_id"),
        "duplicate_store_id": _duplicated(),
        "invalid_store_type": _not_in("store_type", C.STORE_TYPES),
        "invalid_latitude": _outside("latitude", -90, 90),
        "invalid_longitude": _outside("longitude", -180, 180),
        "invalid_opening_date": _col("opening_date").isNull(),
    }


def _orders() -> HitMap:
    return {
        "required_order_id": _missing("order_id"),
        "duplicate_order_id": _duplicated(),
        "invalid_order_date": _col("order_date").isNull(),
        "invalid_sales_channel": _not_in("sales_channel", C.CHANNEL_CODES),
        "invalid_order_status": _not_in("order_status", C.ORDER_STATUSES),
        "invalid_currency": _not_in("currency", C.CURRENCY_CODES),
        "invalid_order_total": _outside("order_total", 0),
        "orphan_customer_id": _orphan("customer_id"),
        "orphan_store_id": _orphan("store_id"),
    }


def _order_items() -> HitMap:
    quantity = _col("quantity")
    return {
        "required_order_item_id": _missing("order_item_id"),
        "duplicate_order_item_id": _duplicated(),
        "invalid_quantity": quantity.isNull() | (quantity <= 0) | (quantity != F.floor(quantity)),
        "invalid_unit_price": _outside("unit_price", 0),
        "invalid_discount_percent": _outside("discount_percent", 0, 100),
        "orphan_order_id": _orphan("order_id"),
        "orphan_product_id": _orphan("product_id"),
    }


def _payments() -> HitMap:
    return {
        "required_payment_id": _missing("payment_id"),
        "duplicate_payment_id": _duplicated(),
        "invalid_payment_method": _not_in("payment_method", C.PAYMENT_METHOD_CODES),
        "invalid_payment_status": _not_in("payment_status", C.PAYMENT_STATUSES),
        "invalid_payment_amount": _outside("payment_amount", 0),
        "invalid_payment_date": _col("payment_date").isNull(),
        "invalid_currency": _not_in("currency", C.CURRENCY_CODES),
        "orphan_order_id": _orphan("order_id"),
    }


def _deliveries() -> HitMap:
    return {
        "required_delivery_id": _missing("delivery_id"),
        "duplicate_delivery_id": _duplicated(),
        "invalid_delivery_type": _not_in("delivery_type", C.DELIVERY_TYPES),
        "invalid_delivery_status": _not_in("delivery_status", C.DELIVERY_STATUSES),
        "invalid_delivery_distance": _outside("delivery_distance_km", 0),
        "invalid_delivery_time": _outside("delivery_time_minutes", 0, C.MAX_DELIVERY_MINUTES),
        "invalid_delivery_fee": _outside("delivery_fee", 0),
        "orphan_order_id": _orphan("order_id"),
        "orphan_store_id": _orphan("store_id"),
    }


def _exchange_rates() -> HitMap:
    rate = _col("rate_to_inr")
    return {
        "invalid_rate_date": _col("rate_date").isNull(),
        "invalid_currency_code": _not_in("currency_code", C.CURRENCY_CODES),
        "invalid_rate_to_inr": rate.isNull() | (rate <= 0),
        "invalid_inr_rate": (_col("currency_code") == C.BASE_CURRENCY) & (rate != 1),
        "duplicate_exchange_rate": _duplicated(),
    }


SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "customers",
            key=("customer_id",),
            checks=_customers,
            text=(
                "customer_id",
                "first_name",
                "last_name",
                "email",
                "phone",
                "city",
                "state",
                "country",
            ),
            codes=("customer_segment",),
            dates=("signup_date",),
        ),
        TableSpec(
            "products",
            key=("product_id",),
            checks=_products,
            text=("product_id", "product_name", "category", "subcategory", "brand", "supplier"),
            numbers=("unit_cost", "selling_price", "product_rating"),
        ),
        TableSpec(
            "stores",
            key=("store_id",),
            checks=_stores,
            text=("store_id", "store_name", "country", "region", "city"),
            codes=("store_type",),
            numbers=("latitude", "longitude"),
            dates=("opening_date",),
        ),
        TableSpec(
            "orders",
            key=("order_id",),
            checks=_orders,
            text=("order_id", "customer_id", "store_id"),
            codes=("sales_channel", "order_status", "currency"),
            numbers=("order_total",),
            dates=("order_date",),
            parents={"customer_id": "customers", "store_id": "stores"},
        ),
        TableSpec(
            "order_items",
            key=("order_item_id",),
            checks=_order_items,
            text=("order_item_id", "order_id", "product_id"),
            numbers=("unit_price", "discount_percent"),
            integers=("quantity",),
            parents={"order_id": "orders", "product_id": "products"},
        ),
        TableSpec(
            "payments",
            key=("payment_id",),
            checks=_payments,
            text=("payment_id", "order_id"),
            codes=("payment_method", "payment_status", "currency"),
            numbers=("payment_amount",),
            dates=("payment_date",),
            parents={"order_id": "orders"},
        ),
        TableSpec(
            "deliveries",
            key=("delivery_id",),
            checks=_deliveries,
            text=("delivery_id", "order_id", "store_id"),
            codes=("delivery_type", "delivery_status"),
            numbers=("delivery_distance_km", "delivery_fee"),
            integers=("delivery_time_minutes",),
            parents={"order_id": "orders", "store_id": "stores"},
        ),
        TableSpec(
            "exchange_rates",
            key=("currency_code", "rate_date"),
            checks=_exchange_rates,
            codes=("currency_code",),
            numbers=("rate_to_inr",),
            dates=("rate_date",),
        ),
    )
}
