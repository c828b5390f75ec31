"""Fixed values of the data contract: schemas, code sets, seed rows, rule catalogue.

Everything in this module is a fixed value that results depend on (column
order, allowed codes, surrogate keys of seeded rows, rule names and reason
texts).  There is no logic here.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Source tables, in dependency order, with their typed columns.
# --------------------------------------------------------------------------
MONEY = "decimal(12,2)"
AMOUNT = "decimal(14,2)"
RATE = "decimal(18,6)"

SOURCE_SCHEMAS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "string",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "phone": "string",
        "city": "string",
        "state": "string",
        "country": "string",
        "customer_segment": "string",
        "signup_date": "date",
    },
    "products": {
        "product_id": "string",
        "product_name": "string",
        "category": "string",
        "subcategory": "string",
        "brand": "string",
        "supplier": "string",
        "unit_cost": MONEY,
        "selling_price": MONEY,
        "product_rating": "decimal(3,1)",
    },
    "stores": {
        "store_id": "string",
        "store_name": "string",
        "store_type": "string",
        "country": "string",
        "region": "string",
        "city": "string",
        "latitude": "decimal(9,6)",
        "longitude": "decimal(10,6)",
        "opening_date": "date",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "store_id": "string",
        "order_date": "date",
        "sales_channel": "string",
        "order_status": "string",
        "currency": "string",
        "order_total": AMOUNT,
    },
    "order_items": {
        "order_item_id": "string",
        "order_id": "string",
        "product_id": "string",
        "quantity": "int",
        "unit_price": MONEY,
        "discount_percent": "decimal(5,2)",
    },
    "payments": {
        "payment_id": "string",
        "order_id": "string",
        "payment_method": "string",
        "payment_status": "string",
        "payment_amount": AMOUNT,
        "payment_date": "date",
        "currency": "string",
    },
    "deliveries": {
        "delivery_id": "string",
        "order_id": "string",
        "store_id": "string",
        "delivery_type": "string",
        "delivery_status": "string",
        "delivery_distance_km": "decimal(10,2)",
        "delivery_time_minutes": "int",
        "delivery_fee": MONEY,
    },
    "exchange_rates": {
        "rate_date": "date",
        "currency_code": "string",
        "rate_to_inr": RATE,
    },
}

SOURCE_TABLES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)

# --------------------------------------------------------------------------
# Allowed codes.
# --------------------------------------------------------------------------
ORDER_STATUSES = (
    "PENDING",
    "CONFIRMED",
    "PROCESSING",
    "SHIPPED",
    "DELIVERED",
    "CANCELLED",
    "RETURNED",
)
PAYMENT_STATUSES = ("SUCCESS", "FAILED", "PENDING", "REFUNDED")
DELIVERY_TYPES = ("STANDARD", "EXPRESS", "QUICK")
DELIVERY_STATUSES = ("ASSIGNED", "IN_TRANSIT", "DELIVERED", "FAILED", "CANCELLED")
STORE_TYPES = ("RETAIL_STORE", "DARK_STORE", "FULFILLMENT_CENTER")
CUSTOMER_SEGMENTS = ("NEW", "REGULAR", "PREMIUM", "VIP", "WHOLESALE")
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL")

MAX_DELIVERY_MINUTES = 200000
QUALITY_THRESHOLD = 95.0
BASE_CURRENCY = "INR"
OVERALL_RULE = "overall_table_quality"

# --------------------------------------------------------------------------
# Seeded dimension rows (key, code, name, ...).
# --------------------------------------------------------------------------
CHANNEL_SCHEMA = "channel_key int, channel_code string, channel_name string, channel_group string"
CHANNELS = (
    (1, "WEBSITE", "Website", "DIGITAL"),
    (2, "MOBILE_APP", "Mobile App", "DIGITAL"),
    (3, "PHYSICAL_STORE", "Physical Store", "PHYSICAL"),
    (4, "QUICK_COMMERCE", "Quick Commerce", "QUICK_COMMERCE"),
)

CURRENCY_SCHEMA = (
    "currency_key int, currency_code string, currency_name string, "
    "currency_symbol string, rate_to_inr decimal(18,6)"
)
CURRENCIES = (
    (1, "INR", "Indian Rupee", "Rs", "1.000000"),
    (2, "USD", "United States Dollar", "$", "83.500000"),
    (3, "GBP", "British Pound Sterling", "GBP", "106.200000"),
    (4, "EUR", "Euro", "EUR", "90.400000"),
    (5, "AED", "UAE Dirham", "AED", "22.730000"),
    (6, "SGD", "Singapore Dollar", "S$", "62.100000"),
    (7, "AUD", "Australian Dollar", "A$", "54.800000"),
    (8, "CAD", "Canadian Dollar", "C$", "61.200000"),
    (9, "JPY", "Japanese Yen", "JPY", "0.560000"),
    (10, "SAR", "Saudi Riyal", "SAR", "22.260000"),
    (11, "MYR", "Malaysian Ringgit", "RM", "18.700000"),
    (12, "NZD", "New Zealand Dollar", "NZ$", "50.400000"),
)

PAYMENT_METHOD_SCHEMA = (
    "payment_method_key int, payment_method_code string, "
    "payment_method_name string, payment_type string"
)
PAYMENT_METHODS = (
    (1, "CREDIT_CARD", "Credit Card", "CARD"),
    (2, "DEBIT_CARD", "Debit Card", "CARD"),
    (3, "UPI", "UPI", "BANK"),
    (4, "NET_BANKING", "Net Banking", "BANK"),
    (5, "WALLET", "Wallet", "WALLET"),
    (6, "CASH", "Cash", "CASH"),
    (7, "PAYPAL", "PayPal", "ONLINE"),
)

CHANNEL_CODES = tuple(row[1] for row in CHANNELS)
CURRENCY_CODES = tuple(row[1] for row in CURRENCIES)
PAYMENT_METHOD_CODES = tuple(row[1] for row in PAYMENT_METHODS)

CALENDAR_FIRST_DAY = "2015-01-01"
CALENDAR_LAST_DAY = "2030-12-31"

# --------------------------------------------------------------------------
# Rule names and reason texts, in evaluation order.
# --------------------------------------------------------------------------
RULE_REASONS: dict[str, dict[str, str]] = {
    "customers": {
        "required_customer_id": "customer_id is missing",
        "duplicate_customer_id": "duplicate customer_id",
        "required_email": "email is missing",
        "invalid_email_format": "email must contain @",
        "invalid_signup_date": "signup_date is not a valid date",
        "invalid_customer_segment": "customer_segment is missing or not in the allowed set",
    },
    "products": {
        "required_product_id": "product_id is missing",
        "duplicate_product_id": "duplicate product_id",
        "required_product_name": "product_name is missing",
        "required_category": "category is missing",
        "invalid_unit_cost": "unit_cost is not numeric",
        "invalid_selling_price": "selling_price is not numeric",
        "negative_unit_cost": "unit_cost must be >= 0",
        "negative_selling_price": "selling_price must be >= 0",
        "unit_cost_exceeds_selling_price": "unit_cost must be <= selling_price",
        "invalid_product_rating": "product_rating must be a number between 0 and 5",
    },
    "stores": {
        "required_store_id": "store_id is missing",
        "duplicate_store_id": "duplicate store_id",
        "invalid_store_type": "store_type is invalid",
        "invalid_latitude": "latitude must be between -90 and 90",
        "invalid_longitude": "longitude must be between -180 and 180",
        "invalid_opening_date": "opening_date is not a valid date",
    },
    "orders": {
        "required_order_id": "order_id is missing",
        "duplicate_order_id": "duplicate order_id",
        "invalid_order_date": "order_date is not a valid date",
        "invalid_sales_channel": "sales_channel is invalid",
        "invalid_order_status": "order_status is invalid",
        "invalid_currency": "currency code is invalid",
        "invalid_order_total": "order_total must be a number >= 0",
        "orphan_customer_id": "customer_id not found in valid customers",
        "orphan_store_id": "store_id not found in valid stores",
    },
    "order_items": {
        "required_order_item_id": "order_item_id is missing",
        "duplicate_order_item_id": "duplicate order_item_id",
        "invalid_quantity": "quantity must be an integer > 0",
        "invalid_unit_price": "unit_price must be a number >= 0",
        "invalid_discount_percent": "discount_percent must be between 0 and 100",
        "orphan_order_id": "order_id not found in valid orders",
        "orphan_product_id": "product_id not found in valid products",
    },
    "payments": {
        "required_payment_id": "payment_id is missing",
        "duplicate_payment_id": "duplicate payment_id",
        "invalid_payment_method": "payment_method is invalid",
        "invalid_payment_status": "payment_status is invalid",
        "invalid_payment_amount": "payment_amount must be >= 0",
        "invalid_payment_date": "payment_date is not a valid date",
        "invalid_currency": "currency code is invalid",
        "orphan_order_id": "order_id not found in valid orders",
    },
    "deliveries": {
        "required_delivery_id": "delivery_id is missing",
        "duplicate_delivery_id": "duplicate delivery_id",
        "invalid_delivery_type": "delivery_type is invalid",
        "invalid_delivery_status": "delivery_status is invalid",
        "invalid_delivery_distance": "delivery_distance_km must be >= 0",
        "invalid_delivery_time": "delivery_time_minutes must be a realistic non-negative number",
        "invalid_delivery_fee": "delivery_fee must be >= 0",
        "orphan_order_id": "order_id not found in valid orders",
        "orphan_store_id": "store_id not found in valid stores",
    },
    "exchange_rates": {
        "invalid_rate_date": "rate_date is not a valid date",
        "invalid_currency_code": "currency_code is invalid",
        "invalid_rate_to_inr": "rate_to_inr must be > 0",
        "invalid_inr_rate": "INR rate_to_inr must equal 1",
        "duplicate_exchange_rate": "duplicate currency_code + rate_date",
    },
}

# --------------------------------------------------------------------------
# Warehouse load columns and their types.
# --------------------------------------------------------------------------
FACT_SALES_SCHEMA: dict[str, str] = {
    "date_key": "int",
    "customer_key": "bigint",
    "product_key": "bigint",
    "store_key": "bigint",
    "channel_key": "int",
    "currency_key": "int",
    "payment_method_key": "int",
    "source_order_id": "string",
    "source_order_item_id": "string",
    "quantity": "int",
    "unit_price": MONEY,
    "gross_amount": AMOUNT,
    "discount_amount": AMOUNT,
    "net_amount": AMOUNT,
    "cost_amount": AMOUNT,
    "profit_amount": AMOUNT,
    "gross_amount_inr": AMOUNT,
    "discount_amount_inr": AMOUNT,
    "net_amount_inr": AMOUNT,
    "cost_amount_inr": AMOUNT,
    "profit_amount_inr": AMOUNT,
    "order_status": "string",
}

FACT_DELIVERY_SCHEMA: dict[str, str] = {
    "date_key": "int",
    "customer_key": "bigint",
    "store_key": "bigint",
    "channel_key": "int",
    "source_order_id": "string",
    "delivery_id": "string",
    "delivery_type": "string",
    "delivery_status": "string",
    "delivery_distance_km": "decimal(10,2)",
    "delivery_time_minutes": "int",
    "delivery_fee": MONEY,
}

RUN_LEDGER_SCHEMA: dict[str, str] = {
    "run_id": "bigint",
    "pipeline_name": "string",
    "event": "string",
    "event_ts": "timestamp",
    "status": "string",
    "records_extracted": "bigint",
    "records_validated": "bigint",
    "records_rejected": "bigint",
    "records_loaded": "bigint",
    "quality_score": "decimal(5,2)",
    "error_message": "string",
}

REJECT_COLUMNS = (
    "pipeline_run_id",
    "source_table",
    "record_identifier",
    "rejection_reason",
    "failed_rule",
    "original_record",
)
