"""Independent SQL for every query, written against the raw sample tables.

Common table expressions are named here once; ``_with`` puts in front of a
statement exactly those it (transitively) names.  The dialect is DuckDB's.
Nothing here reads a result of the Spark code.
"""

from __future__ import annotations

import re

from tradeloom import contracts as C

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def _with(sql: str) -> str:
    """Prefix a statement with the named expressions it needs, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + sql


def _case(column: str, pairs: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def _nth(options: tuple[str, ...], index: str) -> str:
    return "[" + ", ".join(f"'{o}'" for o in options) + f"][({index}) % {len(options)} + 1]"


def _codes(options: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{o}'" for o in options) + ")"


def _clean(column: str) -> str:
    return rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"


def _money(cents: str) -> str:
    return f"CAST({cents} AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2))"


# --------------------------------------------------------------------------
# Staged (typed, valid) sources.
# --------------------------------------------------------------------------
CTES["places"] = """
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey"""

CTES["stg_customers"] = f"""
SELECT c_custkey AS k, c_custkey * 2 + 1 AS raw_id,
  'CUST-' || c_custkey AS customer_id,
  split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
  lower(split_part(c_name, '#', 1)) || split_part(c_name, '#', 2) || '@example.com' AS email,
  '+91-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
  'City ' || c_nationkey AS city, r_name AS state, n_name AS country,
  {_case("c_mktsegment", {"AUTOMOBILE": "NEW", "BUILDING": "REGULAR", "FURNITURE": "PREMIUM",
                          "HOUSEHOLD": "VIP", "MACHINERY": "WHOLESALE"})} AS customer_segment,
  DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date
FROM customer JOIN places ON n_nationkey = c_nationkey"""

CTES["stg_products"] = f"""
SELECT p_partkey AS k, p_partkey + 1 AS raw_id, 'PRD-' || p_partkey AS product_id,
  p_name AS product_name, p_type AS category, 'SIZE-' || p_size AS subcategory,
  p_brand AS brand, 'Vendor ' || p_size AS supplier,
  CAST({_money("CAST(round(p_retailprice * 100) AS BIGINT) * 7 // 10")} AS DECIMAL(12,2)) AS unit_cost,
  CAST({_money("CAST(round(p_retailprice * 100) AS BIGINT)")} AS DECIMAL(12,2)) AS selling_price,
  CAST(CAST(p_partkey % 51 AS DECIMAL(2,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(3,1))
    AS product_rating
FROM part"""

CTES["stg_stores"] = f"""
SELECT s_suppkey AS k, s_suppkey + 1 AS raw_id, 'STR-' || s_suppkey AS store_id,
  s_name AS store_name, {_nth(C.STORE_TYPES, "s_suppkey")} AS store_type,
  n_name AS country, r_name AS region, 'City ' || s_nationkey AS city,
  s_nationkey * 7 - 85 AS latitude, s_nationkey * 14 - 170 AS longitude,
  DATE '1985-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS opening_date
FROM supplier JOIN places ON n_nationkey = s_nationkey"""

CTES["stg_orders"] = f"""
SELECT o_orderkey AS k, o_orderkey * 2 + 1 AS raw_id, 'ORD-' || o_orderkey AS order_id,
  'CUST-' || o_custkey AS customer_id,
  'STR-' || (o_orderkey % (SELECT count(*) FROM supplier)) AS store_id,
  CAST(o_orderdate AS DATE) AS order_date,
  {_case("o_orderpriority", {"1-URGENT": "QUICK_COMMERCE", "2-HIGH": "MOBILE_APP",
                             "3-MEDIUM": "WEBSITE", "4-NOT SPECIFIED": "PHYSICAL_STORE",
                             "5-LOW": "WEBSITE"})} AS sales_channel,
  {_case("o_orderstatus", {"F": "DELIVERED", "O": "SHIPPED", "P": "PENDING"})} AS order_status,
  {_nth(C.CURRENCY_CODES, "o_custkey")} AS currency,
  CAST({_money("CAST(round(o_totalprice * 100) AS BIGINT)")} AS DECIMAL(14,2)) AS order_total
FROM orders"""

CTES["stg_items"] = f"""
SELECT l_orderkey + l_linenumber AS k, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  strftime(l_shipdate, '%Y%m%d') AS shipped,
  'ITEM-' || l_orderkey || '-' || l_linenumber AS short_id,
  'ITEM-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
    || CAST(round(l_extendedprice * 100) AS BIGINT) || '-' || strftime(l_shipdate, '%Y%m%d')
    AS order_item_id,
  'ORD-' || l_orderkey AS order_id, 'PRD-' || l_partkey AS product_id,
  CAST(l_quantity AS INTEGER) AS quantity,
  CAST({_money("(2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))")}
    AS DECIMAL(12,2)) AS unit_price,
  CAST(round(l_discount * 100) AS INTEGER) AS discount_percent
FROM lineitem"""

CTES["stg_payments"] = f"""
SELECT k, k * 2 + attempt AS raw_id, 'PAY-' || k || '-' || attempt AS payment_id, order_id,
  {_nth(C.PAYMENT_METHOD_CODES, "k + attempt")} AS payment_method,
  CASE WHEN k % 16 = 0 AND attempt = 1 THEN 'FAILED' WHEN k % 16 = 0 THEN 'SUCCESS'
       WHEN order_status = 'PENDING' THEN 'PENDING' ELSE 'SUCCESS' END AS payment_status,
  order_total AS payment_amount, order_date + (attempt - 1) AS payment_date, currency
FROM stg_orders JOIN (VALUES (1), (2)) AS a(attempt) ON attempt = 1 OR k % 16 = 0"""

CTES["stg_deliveries"] = f"""
SELECT k, k + 1 AS raw_id, 'DEL-' || k AS delivery_id, order_id, store_id,
  CASE sales_channel WHEN 'QUICK_COMMERCE' THEN 'QUICK' WHEN 'MOBILE_APP' THEN 'EXPRESS'
       ELSE 'STANDARD' END AS delivery_type,
  CASE WHEN k % 19 = 0 THEN 'FAILED' WHEN k % 23 = 0 THEN 'CANCELLED'
       WHEN order_status = 'DELIVERED' THEN 'DELIVERED' WHEN order_status = 'SHIPPED' THEN 'IN_TRANSIT'
       ELSE 'ASSIGNED' END AS delivery_status,
  CAST({_money("k * 37 % 5000")} AS DECIMAL(10,2)) AS delivery_distance_km,
  CAST(k * 13 % 2880 AS INTEGER) AS delivery_time_minutes,
  CAST({_money("k * 17 % 3000")} AS DECIMAL(12,2)) AS delivery_fee
FROM stg_orders WHERE sales_channel <> 'PHYSICAL_STORE'"""

CTES["seed_currency"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({k}, '{code}', '{name}', '{symbol}', CAST({rate} AS DECIMAL(18,6)))"
    for k, code, name, symbol, rate in C.CURRENCIES
) + ") AS t(currency_key, currency_code, currency_name, currency_symbol, rate_to_inr)"

CTES["seed_channel"] = "SELECT * FROM (VALUES " + ", ".join(
    str(row) for row in C.CHANNELS
) + ") AS t(channel_key, channel_code, channel_name, channel_group)"

CTES["seed_method"] = "SELECT * FROM (VALUES " + ", ".join(
    str(row) for row in C.PAYMENT_METHODS
) + ") AS t(payment_method_key, payment_method_code, payment_method_name, payment_type)"

CTES["stg_rates"] = """
SELECT day(d) AS k, date_diff('day', DATE '1970-01-01', d) * 100 + currency_key * 2 AS raw_id,
  d AS rate_date, currency_code,
  CAST(CASE WHEN currency_code = 'INR' THEN 1
       ELSE CAST(rate_to_inr AS DECIMAL(6,2))
            * CAST(((n + dayofyear(d) + currency_key) % 21 + 990) AS DECIMAL(4,0))
            * CAST(0.001 AS DECIMAL(4,3)) END AS DECIMAL(12,5)) AS rate_to_inr
FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1)
CROSS JOIN seed_currency
WHERE currency_code = 'INR'
   OR (isodow(d) < 6 AND (currency_code <> 'NZD' OR isodow(d) = 1))"""

CTES["stg_daily_rates"] = CTES["stg_rates"].replace(
    "FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1)",
    """FROM (SELECT s.d, count(o_orderdate) AS n
      FROM (SELECT CAST(unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
                   (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d) s
      LEFT JOIN orders ON CAST(o_orderdate AS DATE) = s.d GROUP BY 1)""",
)

# --------------------------------------------------------------------------
# Dirty sources as text.
# --------------------------------------------------------------------------
CTES["raw_customers"] = r"""
SELECT raw_id + copy - 1 AS _raw_id, customer_id, first_name, last_name,
  CASE WHEN k % 97 = 0 THEN '' WHEN k % 89 = 1 THEN replace(email, '@', ' at ') ELSE email END AS email,
  phone,
  CASE WHEN copy = 2 THEN 'Second copy' WHEN k % 67 = 3 THEN replace(city, ' ', ' ' || chr(9) || ' ')
       ELSE city END AS city,
  state,
  CASE WHEN k % 61 = 2 THEN '  ' || country || chr(10) ELSE country END AS country,
  CASE WHEN k % 53 = 0 THEN lower(customer_segment) WHEN k % 103 = 5 THEN 'GOLD'
       ELSE customer_segment END AS customer_segment,
  CASE WHEN k % 101 = 0 THEN '2020-02-30'
       WHEN k % 43 = 1 THEN strftime(signup_date, '%m/%d/%Y')
       WHEN k % 47 = 2 THEN strftime(signup_date, '%d-%b-%Y')
       WHEN k % 41 = 3 THEN strftime(signup_date, '%Y%m%d')
       WHEN k % 37 = 4 THEN strftime(signup_date, '%b %-d, %Y')
       WHEN k % 59 = 5 THEN CAST(signup_date AS VARCHAR) || ' 10:30:00'
       ELSE CAST(signup_date AS VARCHAR) END AS signup_date
FROM stg_customers JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR k % 113 = 0"""

CTES["raw_products"] = """
SELECT raw_id AS _raw_id, product_id, product_name,
  CASE WHEN k % 61 = 2 THEN ' ' || category || chr(9) WHEN k % 131 = 7 THEN '   ' ELSE category END
    AS category,
  subcategory, brand, supplier,
  CASE WHEN k % 199 = 1 THEN CAST(selling_price + unit_cost AS VARCHAR) WHEN k % 103 = 6 THEN ''
       WHEN k % 139 = 8 THEN '-5' ELSE CAST(unit_cost AS VARCHAR) END AS unit_cost,
  CASE WHEN k % 211 = 0 THEN '-' || selling_price WHEN k % 97 = 4 THEN '1,000'
       WHEN k % 89 = 5 THEN ' 1.5e3 ' ELSE CAST(selling_price AS VARCHAR) END AS selling_price,
  CASE WHEN k % 83 = 3 THEN 'n/a' ELSE CAST(product_rating AS VARCHAR) END AS product_rating
FROM stg_products"""

CTES["raw_stores"] = """
SELECT raw_id AS _raw_id, store_id, store_name,
  CASE WHEN k % 37 = 1 THEN 'STORE' ELSE store_type END AS store_type, country, region, city,
  CASE WHEN k % 41 = 2 THEN '95.5' ELSE CAST(latitude AS VARCHAR) END AS latitude,
  CASE WHEN k % 47 = 7 THEN 'east' ELSE CAST(longitude AS VARCHAR) END AS longitude,
  CASE WHEN k % 43 = 3 THEN 'not-a-date' ELSE CAST(opening_date AS VARCHAR) END AS opening_date
FROM stg_stores"""

CTES["raw_orders"] = """
SELECT raw_id + copy - 1 AS _raw_id, order_id,
  CASE WHEN k % 83 = 0 THEN 'CUST-X' || k ELSE customer_id END AS customer_id,
  CASE WHEN k % 89 = 1 THEN 'STR-X' ELSE store_id END AS store_id,
  CASE WHEN k % 101 = 2 THEN '1998-13-45' WHEN k % 17 = 3 THEN strftime(order_date, '%Y%m%d')
       ELSE CAST(order_date AS VARCHAR) END AS order_date,
  CASE WHEN k % 71 = 4 THEN ' ' || lower(sales_channel) || '  ' WHEN k % 107 = 5 THEN 'FAX'
       ELSE sales_channel END AS sales_channel,
  CASE WHEN k % 67 = 6 THEN 'SHIPED' ELSE order_status END AS order_status,
  CASE WHEN k % 79 = 0 THEN 'XXX' WHEN k % 29 = 7 THEN lower(currency) ELSE currency END AS currency,
  CASE WHEN k % 73 = 8 THEN '-1.0' ELSE CAST(order_total AS VARCHAR) END AS order_total
FROM stg_orders JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR k % 127 = 0"""

CTES["raw_items"] = """
SELECT l_partkey, l_suppkey, cents, shipped, short_id AS order_item_id, order_id,
  CASE WHEN k % 109 = 1 THEN 'PRD-X' ELSE product_id END AS product_id,
  CASE WHEN k % 67 = 0 THEN '0' WHEN k % 97 = 2 THEN '2.5' WHEN k % 103 = 3 THEN 'two'
       ELSE CAST(quantity AS VARCHAR) END AS quantity,
  CASE WHEN k % 71 = 4 THEN '-9.99' WHEN k % 113 = 5 THEN '0.0' ELSE CAST(unit_price AS VARCHAR) END
    AS unit_price,
  CASE WHEN k % 83 = 6 THEN '150' ELSE CAST(discount_percent AS VARCHAR) END AS discount_percent
FROM stg_items"""

CTES["raw_payments"] = """
SELECT raw_id AS _raw_id, payment_id, order_id,
  CASE WHEN k % 97 = 1 THEN 'CHEQUE' ELSE payment_method END AS payment_method,
  CASE WHEN k % 73 = 2 THEN 'OK' ELSE payment_status END AS payment_status,
  CASE WHEN k % 61 = 3 THEN '' ELSE CAST(payment_amount AS VARCHAR) END AS payment_amount,
  CASE WHEN k % 89 = 4 THEN 'soon' ELSE CAST(payment_date AS VARCHAR) END AS payment_date,
  CASE WHEN k % 79 = 5 THEN 'EURO' ELSE currency END AS currency
FROM stg_payments"""

CTES["raw_deliveries"] = """
SELECT raw_id AS _raw_id, delivery_id, order_id,
  CASE WHEN k % 89 = 2 THEN 'STR-X' ELSE store_id END AS store_id,
  CASE WHEN k % 61 = 3 THEN 'DRONE' ELSE delivery_type END AS delivery_type,
  CASE WHEN k % 67 = 4 THEN 'LOST' ELSE delivery_status END AS delivery_status,
  CASE WHEN k % 71 = 5 THEN 'far' ELSE CAST(delivery_distance_km AS VARCHAR) END
    AS delivery_distance_km,
  CASE WHEN k % 59 = 0 THEN '-15' WHEN k % 97 = 6 THEN '999999'
       ELSE CAST(delivery_time_minutes AS VARCHAR) END AS delivery_time_minutes,
  CASE WHEN k % 103 = 7 THEN '-2.50' ELSE CAST(delivery_fee AS VARCHAR) END AS delivery_fee
FROM stg_deliveries"""

CTES["raw_rates"] = """
SELECT raw_id + copy - 1 AS _raw_id,
  CASE WHEN k = 30 AND currency_code = 'GBP' THEN 'bad' ELSE CAST(rate_date AS VARCHAR) END AS rate_date,
  CASE WHEN k = 21 AND currency_code = 'EUR' THEN 'EURO'
       WHEN k = 22 AND currency_code = 'EUR' THEN ' eur ' ELSE currency_code END AS currency_code,
  CASE WHEN copy = 2 THEN '90.25' WHEN k = 13 AND currency_code = 'INR' THEN '1.05'
       WHEN k = 28 AND currency_code = 'JPY' THEN '0' ELSE CAST(rate_to_inr AS VARCHAR) END AS rate_to_inr
FROM stg_rates JOIN (VALUES (1), (2)) AS c(copy)
  ON copy = 1 OR (k = 7 AND currency_code = 'USD')"""

RAW_SOURCES = {
    "customers": "raw_customers",
    "products": "raw_products",
    "stores": "raw_stores",
    "orders": "raw_orders",
    "order_items": "raw_items",
    "payments": "raw_payments",
    "deliveries": "raw_deliveries",
    "exchange_rates": "raw_rates",
}

# --------------------------------------------------------------------------
# Normalised dirty sources and their rule conditions (b1 .. bn, rule order).
# --------------------------------------------------------------------------
_FORMATS = (
    "['%Y-%m-%d', '%Y%m%d', '%m/%d/%Y', '%d-%b-%Y', '%b %-d, %Y', '%Y-%m-%d %H:%M:%S']"
)


def _date(column: str) -> str:
    return f"CAST(try_strptime(trim({column}), {_FORMATS}) AS DATE)"


def _number(column: str) -> str:
    return f"TRY_CAST(trim({column}) AS DOUBLE)"


CTES["norm_customers"] = f"""
SELECT _raw_id, {_clean("customer_id")} AS customer_id, {_clean("first_name")} AS first_name,
  {_clean("last_name")} AS last_name, {_clean("email")} AS email, {_clean("phone")} AS phone,
  {_clean("city")} AS city, {_clean("state")} AS state, {_clean("country")} AS country,
  upper({_clean("customer_segment")}) AS customer_segment, {_date("signup_date")} AS signup_date
FROM raw_customers"""

CTES["norm_products"] = f"""
SELECT _raw_id, product_id, product_name, {_clean("category")} AS category, subcategory, brand,
  supplier, {_number("unit_cost")} AS unit_cost, {_number("selling_price")} AS selling_price,
  {_number("product_rating")} AS product_rating
FROM raw_products"""

CTES["norm_stores"] = f"""
SELECT _raw_id, store_id, store_name, store_type, country, region, city,
  {_number("latitude")} AS latitude, {_number("longitude")} AS longitude,
  {_date("opening_date")} AS opening_date
FROM raw_stores"""

CTES["norm_orders"] = f"""
SELECT _raw_id, order_id, customer_id, store_id, {_date("order_date")} AS order_date,
  upper({_clean("sales_channel")}) AS sales_channel, order_status, upper(currency) AS currency,
  {_number("order_total")} AS order_total
FROM raw_orders"""

CTES["norm_items"] = f"""
SELECT l_partkey, l_suppkey, cents, shipped, order_item_id, order_id, product_id,
  {_number("quantity")} AS quantity, {_number("unit_price")} AS unit_price,
  {_number("discount_percent")} AS discount_percent
FROM raw_items"""

CTES["norm_payments"] = f"""
SELECT _raw_id, payment_id, order_id, payment_method, payment_status,
  {_number("payment_amount")} AS payment_amount, {_date("payment_date")} AS payment_date, currency
FROM raw_payments"""

CTES["norm_deliveries"] = f"""
SELECT _raw_id, delivery_id, order_id, store_id, delivery_type, delivery_status,
  {_number("delivery_distance_km")} AS delivery_distance_km,
  {_number("delivery_time_minutes")} AS delivery_time_minutes,
  {_number("delivery_fee")} AS delivery_fee
FROM raw_deliveries"""

CTES["norm_rates"] = f"""
SELECT _raw_id, {_date("rate_date")} AS rate_date, upper({_clean("currency_code")}) AS currency_code,
  {_number("rate_to_inr")} AS rate_to_inr
FROM raw_rates"""


def _repeat(key: str, order: str = "_raw_id") -> str:
    return f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) > 1 AND {key.split(',')[0]} <> ''"


def _orphan(column: str, ok: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {ok} p WHERE p.{column} = t.{column})"


CONDITIONS: dict[str, tuple[str, list[str]]] = {
    "customers": (
        "norm_customers",
        [
            "customer_id = ''",
            _repeat("customer_id"),
            "email = ''",
            "email <> '' AND email NOT LIKE '%@%'",
            "signup_date IS NULL",
            f"customer_segment NOT IN {_codes(C.CUSTOMER_SEGMENTS)}",
        ],
    ),
    "products": (
        "norm_products",
        [
            "product_id = ''",
            _repeat("product_id"),
            "product_name = ''",
            "category = ''",
            "unit_cost IS NULL",
            "selling_price IS NULL",
            "coalesce(unit_cost < 0, FALSE)",
            "coalesce(selling_price < 0, FALSE)",
            "coalesce(unit_cost > selling_price, FALSE)",
            "coalesce(product_rating NOT BETWEEN 0 AND 5, TRUE)",
        ],
    ),
    "stores": (
        "norm_stores",
        [
            "store_id = ''",
            _repeat("store_id"),
            f"store_type NOT IN {_codes(C.STORE_TYPES)}",
            "coalesce(latitude NOT BETWEEN -90 AND 90, TRUE)",
            "coalesce(longitude NOT BETWEEN -180 AND 180, TRUE)",
            "opening_date IS NULL",
        ],
    ),
    "orders": (
        "norm_orders",
        [
            "order_id = ''",
            _repeat("order_id"),
            "order_date IS NULL",
            f"sales_channel NOT IN {_codes(C.CHANNEL_CODES)}",
            f"order_status NOT IN {_codes(C.ORDER_STATUSES)}",
            f"currency NOT IN {_codes(C.CURRENCY_CODES)}",
            "coalesce(order_total < 0, TRUE)",
            _orphan("customer_id", "ok_customers"),
            _orphan("store_id", "ok_stores"),
        ],
    ),
    "order_items": (
        "norm_items",
        [
            "order_item_id = ''",
            _repeat("order_item_id", "l_partkey, l_suppkey, cents, shipped"),
            "coalesce(quantity <= 0 OR quantity <> round(quantity), TRUE)",
            "coalesce(unit_price < 0, TRUE)",
            "coalesce(discount_percent NOT BETWEEN 0 AND 100, TRUE)",
            _orphan("order_id", "ok_orders"),
            _orphan("product_id", "ok_products"),
        ],
    ),
    "payments": (
        "norm_payments",
        [
            "payment_id = ''",
            _repeat("payment_id"),
            f"payment_method NOT IN {_codes(C.PAYMENT_METHOD_CODES)}",
            f"payment_status NOT IN {_codes(C.PAYMENT_STATUSES)}",
            "coalesce(payment_amount < 0, TRUE)",
            "payment_date IS NULL",
            f"currency NOT IN {_codes(C.CURRENCY_CODES)}",
            _orphan("order_id", "ok_orders"),
        ],
    ),
    "deliveries": (
        "norm_deliveries",
        [
            "delivery_id = ''",
            _repeat("delivery_id"),
            f"delivery_type NOT IN {_codes(C.DELIVERY_TYPES)}",
            f"delivery_status NOT IN {_codes(C.DELIVERY_STATUSES)}",
            "coalesce(delivery_distance_km < 0, TRUE)",
            "coalesce(delivery_time_minutes NOT BETWEEN 0 AND 200000, TRUE)",
            "coalesce(delivery_fee < 0, TRUE)",
            _orphan("order_id", "ok_orders"),
            _orphan("store_id", "ok_stores"),
        ],
    ),
    "exchange_rates": (
        "norm_rates",
        [
            "rate_date IS NULL",
            f"currency_code NOT IN {_codes(C.CURRENCY_CODES)}",
            "coalesce(rate_to_inr <= 0, TRUE)",
            "currency_code = 'INR' AND coalesce(rate_to_inr <> 1, FALSE)",
            "row_number() OVER (PARTITION BY currency_code, rate_date ORDER BY _raw_id) > 1 "
            "AND rate_date IS NOT NULL",
        ],
    ),
}
_SHORT = {"order_items": "items", "exchange_rates": "rates"}


def _first_rule(table: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN b{i} THEN {v}" for i, v in enumerate(values, 1))
    return f"CASE {whens} END"


for _table, (_normal, _bits) in CONDITIONS.items():
    _short = _SHORT.get(_table, _table)
    _flags = ",\n  ".join(f"{b} AS b{i}" for i, b in enumerate(_bits, 1))
    _numbers = [str(i) for i in range(1, len(_bits) + 1)]
    CTES[f"flag_{_short}"] = f"SELECT t.*,\n  {_flags}\nFROM {_normal} t"
    CTES[f"tag_{_short}"] = (
        f"SELECT *, {_first_rule(_table, _numbers)} AS first_rule FROM flag_{_short}"
    )
    CTES[f"ok_{_short}"] = f"SELECT * FROM tag_{_short} WHERE first_rule IS NULL"
    _parts = [
        f"SELECT '{_table}' AS table_name, {i} AS rule_no, '{name}' AS rule_name, "
        f"'{reason}' AS reason, count(*) AS records_checked, "
        f"CAST(count(*) FILTER (WHERE b{i}) AS BIGINT) AS records_failed, "
        f"CAST(count(*) FILTER (WHERE first_rule = {i}) AS BIGINT) AS records_rejected "
        f"FROM tag_{_short}"
        for i, (name, reason) in enumerate(C.RULE_REASONS[_table].items(), 1)
    ]
    CTES[f"count_{_short}"] = "\nUNION ALL ".join(_parts)
    ORACLES[f"rules_{_table}"] = _with(f"SELECT * FROM count_{_short}")

CTES["all_counts"] = "\nUNION ALL ".join(
    f"SELECT * FROM count_{_SHORT.get(t, t)}" for t in C.SOURCE_TABLES
)
CTES["dq"] = """
SELECT table_name, rule_name, records_checked, records_failed,
  CAST(CAST(records_failed AS DOUBLE) / records_checked AS DECIMAL(7,4)) AS failure_rate
FROM (
  SELECT table_name, rule_name, records_checked, records_failed FROM all_counts
  WHERE records_failed > 0
  UNION ALL
  SELECT table_name, 'overall_table_quality', max(records_checked),
         CAST(sum(records_rejected) AS BIGINT)
  FROM all_counts GROUP BY table_name)"""
CTES["scores"] = """
SELECT table_name, records_checked, records_failed AS records_rejected,
  CAST(records_checked - records_failed AS DOUBLE) / records_checked * 100.0 AS quality_score,
  CAST(records_checked - records_failed AS DOUBLE) / records_checked * 100.0 >= 95.0 AS passed
FROM dq WHERE rule_name = 'overall_table_quality'"""

# --------------------------------------------------------------------------
# Rates, order headers and lines.
# --------------------------------------------------------------------------
CTES["newest_rates"] = """
SELECT currency_code, arg_max(rate_to_inr, rate_date) AS latest_rate, max(rate_date) AS latest_date
FROM stg_rates GROUP BY currency_code"""
CTES["priced_orders"] = """
SELECT o.*, CAST(coalesce(r.rate_to_inr, l.latest_rate,
                          CASE WHEN o.currency = 'INR' THEN 1 END) AS DECIMAL(18,6)) AS fx_rate
FROM stg_orders o
LEFT JOIN stg_rates r ON r.currency_code = o.currency AND r.rate_date = o.order_date
LEFT JOIN newest_rates l ON l.currency_code = o.currency"""


def _even(expression: str) -> str:
    return f"CAST(round_even({expression}, 2) AS DECIMAL(14,2))"


CTES["line_money"] = f"""
SELECT *, CAST(gross_amount - discount_amount AS DECIMAL(14,2)) AS net_amount,
  CAST(gross_amount - discount_amount - cost_amount AS DECIMAL(14,2)) AS profit_amount
FROM (
  SELECT *, {_even("CAST(gross_amount AS DECIMAL(22,2)) * CAST(discount_percent AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))")}
    AS discount_amount
  FROM (
    SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.discount_percent,
      o.k AS order_k, o.customer_id, o.store_id, o.order_date, o.sales_channel, o.order_status, o.currency,
      o.fx_rate, p.product_name, p.category, p.brand,
      {_even("CAST(i.quantity AS DECIMAL(20,0)) * i.unit_price")} AS gross_amount,
      {_even("CAST(i.quantity AS DECIMAL(20,0)) * p.unit_cost")} AS cost_amount
    FROM stg_items i JOIN priced_orders o ON o.order_id = i.order_id
    JOIN stg_products p ON p.product_id = i.product_id))"""


def _inr(column: str) -> str:
    return f"{_even(f'CAST({column} AS DECIMAL(20,2)) * fx_rate')} AS {column}_inr"


_MONEY_COLUMNS = (
    "unit_price", "gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount"
)
CTES["sales"] = (
    "SELECT *, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,\n  "
    + ",\n  ".join(_inr(c) for c in _MONEY_COLUMNS)
    + "\nFROM line_money"
)


def _numbered(rows: str, business: str, surrogate: str) -> str:
    """Keys 1..n in the order of the id's MD5."""
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY md5({business}), {business}) "
        f"AS BIGINT) AS {surrogate}, * FROM {rows}"
    )


CTES["key_customer"] = _numbered("stg_customers", "customer_id", "customer_key")
CTES["key_product"] = _numbered("stg_products", "product_id", "product_key")
CTES["key_store"] = _numbered("stg_stores", "store_id", "store_key")
CTES["best_payment"] = """
SELECT order_id, payment_method FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
            ORDER BY CASE WHEN payment_status = 'SUCCESS' THEN 0 ELSE 1 END, raw_id) AS rn
  FROM stg_payments) WHERE rn = 1"""
CTES["delivered"] = """
SELECT CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_key, o.customer_id, d.store_id,
  o.sales_channel, d.order_id AS source_order_id, d.delivery_id, d.delivery_type, d.delivery_status,
  d.delivery_distance_km, d.delivery_time_minutes, d.delivery_fee
FROM stg_deliveries d JOIN stg_orders o ON o.order_id = d.order_id"""

# --------------------------------------------------------------------------
# Marts.
# --------------------------------------------------------------------------
_FIGURES = """CAST(sum(net_amount_inr) AS DECIMAL(24,2)) AS sales,
  count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
  CAST(sum(profit_amount_inr) AS DECIMAL(24,2)) AS profit"""


def _mart(groups: str, joins: str = "") -> str:
    return f"SELECT {groups},\n  {_FIGURES}\nFROM sales f {joins} GROUP BY ALL"


CTES["m_monthly"] = _mart(
    "CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, "
    "monthname(order_date) AS month_name"
)
CTES["m_category"] = _mart("category")
CTES["m_product"] = _mart("product_id, product_name, category, brand")
CTES["m_store"] = _mart(
    "s.store_id, s.store_name, s.store_type, s.country, s.city",
    "JOIN stg_stores s ON s.store_id = f.store_id",
)
CTES["m_channel"] = _mart(
    "channel_code, channel_name, channel_group", "JOIN seed_channel ON channel_code = sales_channel"
)
CTES["m_customer"] = _mart(
    "c.customer_id, c.first_name, c.last_name, c.country, c.customer_segment",
    "JOIN stg_customers c ON c.customer_id = f.customer_id",
)
CTES["m_delivery"] = """
SELECT delivery_type, delivery_status, channel_group, count(*) AS deliveries,
  round(CAST(sum(delivery_distance_km) AS DOUBLE) / count(*), 2) AS avg_distance_km,
  round(CAST(sum(delivery_time_minutes) AS DOUBLE) / count(*), 2) AS avg_time_minutes,
  CAST(sum(delivery_fee) AS DECIMAL(24,2)) AS total_delivery_fee
FROM delivered JOIN seed_channel ON channel_code = sales_channel GROUP BY ALL"""

# --------------------------------------------------------------------------
# Run ledger.
# --------------------------------------------------------------------------
CTES["finished_at"] = """
SELECT event_id,
  CASE WHEN event_type <> 'click'
       THEN make_timestamp(epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 10000) END AS done
FROM events"""
CTES["runs"] = """
SELECT e.event_id AS run_id, 'retail_batch' AS pipeline_name, ts AS started_at, done AS completed_at,
  CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN done IS NOT NULL THEN e.event_id % 1000 + 100 END AS records_extracted,
  CASE WHEN done IS NOT NULL THEN e.event_id % 1000 + 100 - user_id % 7 END AS records_validated,
  CASE WHEN done IS NOT NULL THEN user_id % 7 END AS records_rejected,
  CASE WHEN done IS NULL THEN NULL WHEN event_type = 'error' THEN 0
       ELSE e.event_id % 1000 + 100 - user_id % 7 END AS records_loaded,
  CASE WHEN done IS NOT NULL
       THEN CAST(CAST(e.event_id % 1000 + 100 - user_id % 7 AS DOUBLE)
                 / CAST(e.event_id % 1000 + 100 AS DOUBLE) * 100.0 AS DECIMAL(5,2)) END AS quality_score,
  CASE WHEN event_type = 'error' THEN 'user ' || user_id END AS error_message
FROM events e JOIN finished_at f ON f.event_id = e.event_id"""
CTES["dq_log"] = f"""
SELECT e.event_id AS run_id, {_nth(C.SOURCE_TABLES, "user_id")} AS table_name, rule_name,
  e.event_id % 1000 + 100 AS records_checked, user_id % 7 AS records_failed,
  CAST(CAST(user_id % 7 AS DOUBLE) / CAST(e.event_id % 1000 + 100 AS DOUBLE) AS DECIMAL(7,4))
    AS failure_rate,
  done AS created_at
FROM events e JOIN finished_at f ON f.event_id = e.event_id
JOIN LATERAL (SELECT unnest(['rule_' || e.event_type, 'overall_table_quality']) AS rule_name) ON TRUE
WHERE event_type <> 'click'"""


def _calendar(day: str) -> str:
    return f"""CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_key, {day} AS full_date,
  CAST(day({day}) AS INTEGER) AS day_of_month, dayname({day}) AS day_name,
  CAST(weekofyear({day}) AS INTEGER) AS week_number, CAST(month({day}) AS INTEGER) AS month_number,
  monthname({day}) AS month_name, CAST(quarter({day}) AS INTEGER) AS quarter_number,
  CAST(year({day}) AS INTEGER) AS year, isodow({day}) IN (6, 7) AS is_weekend"""


def _hierarchy(day: str) -> str:
    return f"""CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter_no,
  'Qtr ' || quarter({day}) AS quarter, CAST(month({day}) AS INTEGER) AS month_no,
  monthname({day}) AS month, CAST(day({day}) AS INTEGER) AS day"""


CTES["seed_days"] = (
    "SELECT CAST(unnest(generate_series(DATE '2015-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) "
    "AS DATE) AS d"
)
CTES["data_days"] = """
SELECT signup_date AS d FROM stg_customers UNION SELECT opening_date FROM stg_stores
UNION SELECT order_date FROM stg_orders UNION SELECT payment_date FROM stg_payments
UNION SELECT rate_date FROM stg_daily_rates"""


def _divide(n: str, d: str) -> str:
    return f"CASE WHEN coalesce({d}, 0) = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"


def _sum(c: str) -> str:
    return f"CAST(sum({c}) AS DECIMAL(24,2))"


def _big(c: str) -> str:
    return f"CAST(sum({c}) AS BIGINT)"


def _oracle(name: str, sql: str) -> None:
    ORACLES[name] = _with(sql)


# --- landing
_oracle(
    "extract_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS records_extracted FROM {r}"
        for t, r in RAW_SOURCES.items()
    ),
)
_oracle("raw_landing", "SELECT * FROM raw_orders")
_STAGED = "TRUE AS _is_valid, 'PASSED' AS _dq_status, CAST(NULL AS VARCHAR) AS _rejection_reason"
_oracle(
    "staging_orders",
    f"""SELECT order_id, customer_id, store_id, order_date, sales_channel, order_status, currency,
  CAST(order_total AS DECIMAL(14,2)) AS order_total, {_STAGED} FROM ok_orders""",
)
_oracle(
    "staging_order_items",
    f"""SELECT order_item_id, order_id, product_id, CAST(quantity AS INTEGER) AS quantity,
  CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
  CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent, {_STAGED} FROM ok_items""",
)
_oracle(
    "seed_if_absent",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CASE WHEN d IN (SELECT CAST(ts AS DATE) FROM events) THEN 'LOADED' ELSE dayname(d) END AS day_name,
  CAST(year(d) AS INTEGER) AS year
FROM (SELECT d FROM seed_days UNION SELECT CAST(ts AS DATE) FROM events) x""",
)

# --- scalars
_oracle(
    "norm_text",
    f"SELECT _raw_id, {_clean('city')} AS city, {_clean('country')} AS country, "
    f"{_clean('email')} AS email FROM raw_customers",
)
_oracle(
    "norm_code",
    f"SELECT _raw_id, upper({_clean('sales_channel')}) AS sales_channel, "
    f"upper({_clean('currency')}) AS currency FROM raw_orders",
)
_oracle(
    "parse_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE (l_orderkey + l_linenumber) % 12
    WHEN 0 THEN l_quantity WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity
    WHEN 3 THEN -(l_quantity + 0.25) WHEN 4 THEN l_quantity * 100
    WHEN 11 THEN l_quantity / (CASE WHEN l_quantity < 10 THEN 10.0 ELSE 100.0 END)
  END AS parsed
FROM lineitem""",
)
_oracle(
    "parse_date",
    """SELECT o_orderkey,
  CASE o_orderkey % 13
    WHEN 3 THEN CASE WHEN day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END
    WHEN 9 THEN make_date(year(d), 1, 1) WHEN 10 THEN NULL WHEN 11 THEN NULL ELSE d
  END AS parsed
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
_oracle(
    "date_key",
    """SELECT order_id, CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date)
  AS INTEGER) AS date_key FROM stg_orders""",
)

# --- validation
_oracle(
    "first_failed_rule",
    f"""SELECT _raw_id, order_id AS record_identifier,
  {_first_rule("orders", [f"'{r}'" for r in C.RULE_REASONS["orders"]])} AS failed_rule,
  {_first_rule("orders", [f"'{r}'" for r in C.RULE_REASONS["orders"].values()])} AS rejection_reason
FROM tag_orders WHERE first_rule IS NOT NULL""",
)
_oracle(
    "dq_rule_counts",
    "SELECT table_name, rule_name, records_checked, records_failed FROM all_counts "
    "WHERE records_failed > 0",
)
_oracle(
    "valid_customers",
    """SELECT _raw_id, customer_id, first_name, last_name, email, phone, city, state, country,
  customer_segment, signup_date FROM ok_customers""",
)
_oracle(
    "orphan_orders",
    """SELECT _raw_id, order_id, customer_id FROM norm_orders
WHERE customer_id NOT IN (SELECT customer_id FROM ok_customers)""",
)
_oracle("quality_scores", "SELECT * FROM scores")
_oracle(
    "quality_gate",
    """SELECT CAST(sum(records_checked) AS BIGINT) AS records_checked,
  CAST(sum(records_rejected) AS BIGINT) AS records_rejected,
  CAST(sum(records_checked) - sum(records_rejected) AS DOUBLE)
    / CAST(sum(records_checked) AS DOUBLE) * 100.0 AS overall_score,
  count(*) FILTER (WHERE NOT passed) AS tables_failed, bool_and(passed) AS passed FROM scores""",
)
_oracle("dq_results", "SELECT * FROM dq")
_oracle("run_ledger_state", "SELECT * FROM runs")


def _reject(table: str, short: str, identifier: str, columns: list[str], shown: dict[str, str]) -> None:
    names = list(C.RULE_REASONS[table])
    values = [f"{shown.get(c, c)} AS {c}" for c in columns]
    packed = ", ".join(f"'{c}': {shown.get(c, c)}" for c in columns)
    _oracle(
        f"rejects_{table}",
        f"""SELECT CAST(1 AS BIGINT) AS pipeline_run_id, '{table}' AS source_table,
  {identifier} AS record_identifier,
  {_first_rule(table, [f"'{r}'" for r in C.RULE_REASONS[table].values()])} AS rejection_reason,
  {_first_rule(table, [f"'{r}'" for r in names])} AS failed_rule,
  CAST(to_json({{{packed}}}) AS VARCHAR) AS original_record,
  {", ".join(values)}
FROM tag_{short} WHERE first_rule IS NOT NULL""",
    )


_reject("customers", "customers", "customer_id", list(C.SOURCE_SCHEMAS["customers"]), {})
_reject(
    "exchange_rates",
    "rates",
    "currency_code || '|' || coalesce(CAST(rate_date AS VARCHAR), '')",
    list(C.SOURCE_SCHEMAS["exchange_rates"]),
    {},
)

# --- amounts and rates
_AMOUNTS = "gross_amount, discount_amount, net_amount, cost_amount, profit_amount"
_oracle(
    "line_amounts",
    f"SELECT order_item_id AS source_order_item_id, quantity, unit_price, {_AMOUNTS} FROM line_money",
)
_oracle(
    "line_amounts_inr",
    "SELECT order_item_id AS source_order_item_id, fx_rate, "
    + ", ".join(f"{c}_inr" for c in _MONEY_COLUMNS)
    + " FROM sales",
)
_oracle(
    "fx_dedup",
    """SELECT currency_code, rate_date, CAST(rate_to_inr AS DECIMAL(18,6)) AS rate_to_inr FROM (
  SELECT *, row_number() OVER (PARTITION BY currency_code, rate_date ORDER BY _raw_id DESC) AS rn
  FROM norm_rates WHERE rate_date IS NOT NULL AND rate_to_inr IS NOT NULL) WHERE rn = 1""",
)
_oracle(
    "fx_latest",
    "SELECT currency_code, CAST(latest_rate AS DECIMAL(18,6)) AS latest_rate, latest_date "
    "FROM newest_rates",
)
_oracle("fx_attach_latest", "SELECT order_id, currency, order_date, fx_rate FROM priced_orders")
_oracle(
    "fx_attach_asof",
    """SELECT o.order_id, o.currency, o.order_date,
  CAST(coalesce(r.rate_to_inr, CASE WHEN o.currency = 'INR' THEN 1 END) AS DECIMAL(18,6)) AS fx_rate
FROM stg_orders o ASOF LEFT JOIN stg_rates r
  ON r.currency_code = o.currency AND o.order_date >= r.rate_date""",
)
_oracle("payment_by_order", "SELECT * FROM best_payment")
_oracle(
    "order_total_rollup",
    """SELECT o.order_id, coalesce(t.total, CAST(0 AS DECIMAL(14,2))) AS order_total
FROM stg_orders o LEFT JOIN (
  SELECT order_id, CAST(round_even(sum(CAST(quantity AS DECIMAL(20,0)) * unit_price
      * CAST(100 - discount_percent AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2))), 2)
      AS DECIMAL(14,2)) AS total
  FROM stg_items GROUP BY order_id) t ON t.order_id = o.order_id""",
)

# --- dimensions
_oracle(
    "dim_date_seed",
    f"""SELECT {_calendar("d")}, coalesce(n, 0) AS runs_started
FROM seed_days LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) e
  ON e.day = d""",
)
_oracle("dim_date_from_data", f"SELECT {_calendar('d')} FROM data_days")
_oracle(
    "dim_date",
    f"SELECT {_calendar('d')} FROM (SELECT d FROM seed_days UNION SELECT d FROM data_days) x",
)
_oracle(
    "dim_customer",
    """SELECT customer_id, first_name, last_name, email, phone, city, state, country,
  customer_segment, signup_date
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _raw_id) AS rn FROM norm_customers)
WHERE rn = 1""",
)
_oracle(
    "dim_product",
    """SELECT product_id, product_name, category, subcategory, brand, supplier,
  CAST(unit_cost AS DECIMAL(12,2)) AS unit_cost, CAST(selling_price AS DECIMAL(12,2)) AS selling_price,
  CAST(product_rating AS DECIMAL(3,1)) AS product_rating FROM norm_products""",
)
_oracle(
    "dim_store",
    """SELECT store_id, store_name, store_type, country, region, city,
  CAST(latitude AS DECIMAL(9,6)) AS latitude, CAST(longitude AS DECIMAL(10,6)) AS longitude,
  opening_date FROM norm_stores""",
)
_oracle(
    "dim_channel",
    """SELECT c.*, (SELECT count(*) FROM stg_orders WHERE sales_channel = channel_code) AS orders
FROM seed_channel c""",
)
_oracle(
    "dim_currency_seed",
    """SELECT c.*, (SELECT count(*) FROM stg_orders WHERE currency = currency_code) AS orders
FROM seed_currency c""",
)
_oracle(
    "dim_payment_method",
    """SELECT m.*, (SELECT count(*) FROM stg_payments WHERE payment_method = payment_method_code)
  AS payments FROM seed_method m""",
)
_oracle(
    "dim_currency_refresh",
    """SELECT currency_key, c.currency_code, currency_name, currency_symbol,
  CAST(coalesce(latest_rate, rate_to_inr) AS DECIMAL(18,6)) AS rate_to_inr
FROM seed_currency c LEFT JOIN newest_rates l ON l.currency_code = c.currency_code""",
)
_oracle(
    "dim_keys",
    """SELECT 'dim_customer' AS dimension, customer_key AS surrogate_key, customer_id AS business_key
FROM key_customer
UNION ALL SELECT 'dim_product', product_key, product_id FROM key_product
UNION ALL SELECT 'dim_store', store_key, store_id FROM key_store""",
)

# --- facts and merges
_FACT_SALES = f"""SELECT f.date_key, customer_key, product_key, store_key, channel_key, currency_key,
  payment_method_key, f.order_id AS source_order_id, order_item_id AS source_order_item_id, quantity,
  unit_price, {_AMOUNTS}, {", ".join(f"{c}_inr" for c in _MONEY_COLUMNS[1:])}, order_status
FROM sales f JOIN key_customer c ON c.customer_id = f.customer_id
JOIN key_product p ON p.product_id = f.product_id JOIN key_store s ON s.store_id = f.store_id
JOIN seed_channel ON channel_code = sales_channel
JOIN seed_currency cu ON cu.currency_code = f.currency
LEFT JOIN best_payment b ON b.order_id = f.order_id
LEFT JOIN seed_method ON payment_method_code = b.payment_method"""
_FACT_DELIVERY = """SELECT date_key, customer_key, store_key, channel_key, source_order_id, delivery_id,
  delivery_type, delivery_status, delivery_distance_km, delivery_time_minutes, delivery_fee
FROM delivered d JOIN key_customer c ON c.customer_id = d.customer_id
JOIN key_store s ON s.store_id = d.store_id JOIN seed_channel ON channel_code = sales_channel"""
_oracle("fact_sales", _FACT_SALES)
_oracle("fact_delivery", _FACT_DELIVERY)
_CUSTOMER = "customer_id, first_name, last_name, email, phone, city, state, country, customer_segment, signup_date"
_oracle(
    "merge_dim_customer",
    f"""SELECT CAST(CASE WHEN early
    THEN row_number() OVER (PARTITION BY early ORDER BY md5(customer_id), customer_id)
    ELSE (SELECT count(*) FROM stg_customers WHERE signup_date < DATE '1994-10-01')
       + row_number() OVER (PARTITION BY early ORDER BY md5(customer_id), customer_id)
    END AS BIGINT) AS customer_key,
  customer_id, first_name, last_name, email, phone,
  CASE WHEN late THEN upper(city) ELSE city END AS city, state, country,
  CASE WHEN late THEN customer_segment ELSE 'NEW' END AS customer_segment, signup_date
FROM (SELECT {_CUSTOMER}, signup_date < DATE '1994-10-01' AS early,
             signup_date >= DATE '1994-04-01' AS late FROM stg_customers)""",
)


def _two_loads(rows: str, key: str, surrogate: str, status: str, shown: str) -> str:
    numbering = f"row_number() OVER (PARTITION BY early ORDER BY md5({key}), {key})"
    return f"""SELECT CAST(CASE WHEN early THEN 0
    ELSE (SELECT count(*) FROM ({rows}) WHERE date_key < 20000101) END + {numbering} AS BIGINT)
    AS {surrogate},
  {shown}, CASE WHEN date_key >= 19980101 THEN {status} ELSE 'EARLIER' END AS {status}
FROM (SELECT *, date_key < 20000101 AS early FROM ({rows}))"""


def _all_but(schema: dict[str, str], column: str) -> str:
    return ", ".join(c for c in schema if c != column)


_oracle(
    "merge_fact_sales",
    _two_loads(
        _FACT_SALES, "source_order_item_id", "sales_key", "order_status", _all_but(C.FACT_SALES_SCHEMA, "order_status")
    ),
)
_oracle(
    "merge_fact_delivery",
    _two_loads(
        _FACT_DELIVERY, "delivery_id", "delivery_key", "delivery_status", _all_but(C.FACT_DELIVERY_SCHEMA, "delivery_status")
    ),
)

# --- marts
for _name in ("monthly", "category", "product", "store", "channel", "customer", "delivery"):
    _oracle("mart_monthly_sales" if _name == "monthly" else f"mart_{_name}", f"SELECT * FROM m_{_name}")

# --- measures
_EXEC = f"""{_sum("sales")} AS total_revenue, {_sum("profit")} AS total_profit,
  {_big("orders")} AS total_orders, {_big("units")} AS units_sold,
  {_divide("sum(profit)", "sum(sales)")} AS profit_margin,
  {_divide("sum(sales)", "sum(orders)")} AS average_order_value"""
_WEIGHTED = ", ".join(
    _divide(
        f"sum(CAST({c} AS DECIMAL(14,2)) * CAST(deliveries AS DECIMAL(18,0)))", "sum(deliveries)"
    )
    + f" AS {n}"
    for c, n in (
        ("avg_time_minutes", "average_delivery_minutes"),
        ("avg_distance_km", "average_delivery_km"),
    )
)
_STORE = f"""{_sum("sales")} AS store_revenue, {_sum("profit")} AS store_profit,
  {_big("orders")} AS store_orders"""
_DELIVERY = f"{_big('deliveries')} AS total_deliveries, {_WEIGHTED}"
_oracle("measures_exec", f"SELECT {_EXEC} FROM m_monthly")
_oracle(
    "measures_customer",
    f"""SELECT count(DISTINCT customer_id) AS purchasing_customers, {_sum("sales")} AS customer_revenue,
  {_sum("profit")} AS customer_profit, {_big("orders")} AS customer_orders,
  {_divide("sum(sales)", "count(DISTINCT customer_id)")} AS revenue_per_customer FROM m_customer""",
)
_oracle("measures_store", f"SELECT {_STORE} FROM m_store")
_oracle("measures_delivery", f"SELECT {_DELIVERY} FROM m_delivery")
_oracle(
    "measures_ops",
    f"SELECT * FROM (SELECT {_STORE} FROM m_store), (SELECT {_DELIVERY} FROM m_delivery)",
)
_oracle(
    "measures_bundle",
    f"""SELECT * FROM (SELECT {_EXEC} FROM m_monthly),
 (SELECT count(DISTINCT customer_id) AS purchasing_customers, {_sum("sales")} AS customer_revenue,
         {_sum("profit")} AS customer_profit FROM m_customer),
 (SELECT {_sum("sales")} AS store_revenue, {_sum("profit")} AS store_profit FROM m_store),
 (SELECT {_DELIVERY} FROM m_delivery)""",
)
_oracle(
    "m_run_counts",
    """SELECT status, count(*) AS total_pipeline_runs,
  (SELECT count(*) FROM runs WHERE status = 'SUCCESS') AS successful_runs,
  (SELECT count(*) FROM runs WHERE status = 'FAILED') AS failed_runs
FROM runs GROUP BY status""",
)
_oracle(
    "m_run_records",
    "SELECT "
    + ", ".join(
        f"{_big(f'records_{k}')} AS records_{k}" for k in ("extracted", "validated", "rejected", "loaded")
    )
    + " FROM runs",
)
_oracle(
    "m_avg_duration",
    """SELECT CAST(sum(date_diff('second', started_at, completed_at)) AS DOUBLE) / count(*)
  AS average_duration_seconds FROM runs WHERE completed_at IS NOT NULL""",
)
_oracle(
    "m_latest_quality",
    """SELECT quality_score AS latest_quality_score FROM runs WHERE completed_at IS NOT NULL
ORDER BY started_at DESC, run_id DESC LIMIT 1""",
)
_DQ = f"""{_big("records_checked")} AS records_checked, {_big("records_failed")} AS records_failed,
  {_divide("sum(records_failed)", "sum(records_checked)")} AS failure_rate"""
_oracle("m_dq", f"SELECT {_DQ} FROM dq_log")
for _name, _mart_name, _by in (
    ("category_share", "m_category", "category"),
    ("channel_share", "m_channel", "channel_name"),
    ("product_share", "m_product", "product_id"),
):
    _oracle(
        _name,
        f"""SELECT {_by}, {_sum("sales")} AS sales,
  {_divide("sum(sales)", f"(SELECT sum(sales) FROM {_mart_name})")} AS revenue_share
FROM {_mart_name} GROUP BY {_by}""",
    )
_oracle(
    "margins",
    " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, {by} AS member, {_divide('sum(profit)', 'sum(sales)')} "
        f"AS profit_margin FROM {cte} GROUP BY {by}"
        for mart, by, cte in (
            ("category_performance", "category", "m_category"),
            ("channel_performance", "channel_name", "m_channel"),
            ("product_performance", "product_id", "m_product"),
        )
    ),
)
_oracle(
    "segment_share",
    f"""SELECT country, customer_segment, {_sum("sales")} AS sales,
  {_divide("sum(sales)", "(SELECT sum(i.sales) FROM m_customer i WHERE i.country = o.country)")}
    AS segment_share
FROM m_customer o GROUP BY country, customer_segment""",
)
_oracle(
    "delivery_status_share",
    f"""SELECT delivery_type, delivery_status, {_big("deliveries")} AS deliveries,
  {_divide("sum(deliveries)", "(SELECT sum(i.deliveries) FROM m_delivery i WHERE i.delivery_type = o.delivery_type)")}
    AS status_share
FROM m_delivery o GROUP BY delivery_type, delivery_status""",
)

# --- reports
_LABEL = "lpad(CAST(year AS VARCHAR), 4, '0') || '-' || lpad(CAST(month AS VARCHAR), 2, '0')"
_oracle(
    "monthly_sales_yearmonth",
    f"SELECT *, year * 100 + month AS year_month_sort, {_LABEL} AS year_month FROM m_monthly",
)
_oracle(
    "rpt_revenue_trend",
    f"""SELECT {_LABEL} AS year_month, year * 100 + month AS year_month_sort, year, month, month_name,
  {_sum("sales")} AS total_revenue FROM m_monthly GROUP BY ALL ORDER BY year_month_sort""",
)
_oracle(
    "rpt_revenue_by_year",
    f"SELECT year, {_sum('sales')} AS total_revenue FROM m_monthly GROUP BY year ORDER BY year",
)
_oracle(
    "rpt_year_filtered",
    f"""SELECT 'monthly_sales' AS mart, CAST(year AS VARCHAR) AS member, {_sum("sales")} AS total_revenue
FROM m_monthly WHERE year = 1998 GROUP BY year
UNION ALL SELECT 'category_performance', category, {_sum("sales")} FROM m_category GROUP BY category""",
)


def _with_share(mart: str, by: str) -> str:
    return f"""SELECT {by}, {_sum("sales")} AS sales, {_sum("profit")} AS profit,
  {_divide("sum(profit)", "sum(sales)")} AS profit_margin,
  {_divide("sum(sales)", f"(SELECT sum(sales) FROM {mart})")} AS revenue_share
FROM {mart} GROUP BY {by}"""


_oracle("rpt_category", _with_share("m_category", "category"))
_oracle("rpt_channel", _with_share("m_channel", "channel_name"))
for _name, _mart_name, _by in (
    ("rpt_channel_profit", "m_channel", "channel_name"),
    ("rpt_category_profit", "m_category", "category"),
):
    _oracle(
        _name,
        f"SELECT {_by}, {_sum('sales')} AS sales, {_sum('profit')} AS profit FROM {_mart_name} "
        f"GROUP BY {_by} ORDER BY sales DESC, {_by}",
    )
_oracle(
    "top_products",
    f"""SELECT product_name, sales, profit, profit_margin, revenue_share FROM (
  SELECT *, rank() OVER (ORDER BY sales DESC) AS r FROM ({_with_share("m_product", "product_name")}))
WHERE r <= 10""",
)
_oracle(
    "rpt_segment",
    f"""SELECT customer_segment, {_sum("sales")} AS customer_revenue, {_sum("profit")} AS customer_profit,
  {_divide("sum(sales)", "(SELECT sum(sales) FROM m_customer)")} AS segment_share
FROM m_customer GROUP BY customer_segment""",
)
_oracle(
    "rpt_customer_country",
    f"SELECT country, {_sum('sales')} AS customer_revenue FROM m_customer GROUP BY country",
)
_oracle(
    "top_customers",
    f"""SELECT first_name, last_name, country, customer_segment, {_big("orders")} AS orders,
  {_big("units")} AS units, {_sum("sales")} AS sales, {_sum("profit")} AS profit
FROM (SELECT *, rank() OVER (ORDER BY sales DESC) AS r FROM m_customer) WHERE r <= 15 GROUP BY ALL""",
)
_oracle(
    "rpt_store_type",
    f"""SELECT store_type, {_sum("sales")} AS store_revenue, {_sum("profit")} AS store_profit
FROM m_store GROUP BY store_type""",
)
_oracle(
    "top_stores",
    f"""SELECT store_name, city, country, {_sum("sales")} AS store_revenue
FROM (SELECT *, rank() OVER (ORDER BY sales DESC) AS r FROM m_store) WHERE r <= 10 GROUP BY ALL""",
)
_oracle(
    "rpt_delivery_status",
    f"""SELECT delivery_status, {_big("deliveries")} AS deliveries,
  {_divide("sum(deliveries)", "(SELECT sum(deliveries) FROM m_delivery)")} AS status_share
FROM m_delivery GROUP BY delivery_status""",
)
_oracle(
    "rpt_delivery_type",
    f"SELECT delivery_type, {_big('deliveries')} AS deliveries FROM m_delivery GROUP BY delivery_type",
)
_oracle(
    "rpt_delivery_matrix",
    f"""SELECT delivery_type, delivery_status, channel_group, {_DELIVERY},
  {_sum("total_delivery_fee")} AS total_delivery_fee
FROM m_delivery GROUP BY delivery_type, delivery_status, channel_group""",
)
_oracle(
    "rpt_runs_by_status",
    "SELECT status, count(*) AS total_pipeline_runs FROM runs GROUP BY status",
)
_oracle("rpt_dq_by_table", f"SELECT table_name, {_DQ} FROM dq_log GROUP BY table_name")
_oracle(
    "rpt_dq_by_rule",
    f"SELECT table_name, rule_name, {_DQ} FROM dq_log GROUP BY table_name, rule_name",
)
_oracle(
    "rpt_dq_by_run_status",
    f"""SELECT table_name, {_DQ} FROM dq_log
WHERE run_id IN (SELECT run_id FROM runs WHERE status = 'FAILED') GROUP BY table_name""",
)
_oracle("rpt_run_log", "SELECT * FROM runs ORDER BY started_at DESC, run_id")
_oracle(
    "slicer_values",
    " UNION ALL ".join(
        f"SELECT DISTINCT '{name}' AS slicer, CAST({c} AS VARCHAR) AS value FROM {source}"
        for name, source, c in (
            ("year", "m_monthly", "year"),
            ("category", "m_product", "category"),
            ("channel", "m_channel", "channel_name"),
            ("customer_segment", "m_customer", "customer_segment"),
            ("customer_country", "m_customer", "country"),
            ("store_type", "m_store", "store_type"),
            ("store_country", "m_store", "country"),
            ("delivery_status", "m_delivery", "delivery_status"),
            ("delivery_type", "m_delivery", "delivery_type"),
            ("channel_group", "m_delivery", "channel_group"),
            ("run_status", "runs", "status"),
            ("dq_table", "dq_log", "table_name"),
        )
    ),
)
_oracle(
    "date_hierarchy",
    f"SELECT date, {_hierarchy('date')} FROM (SELECT DISTINCT CAST(created_at AS DATE) AS date FROM dq_log)",
)
_oracle(
    "runs_by_date_hierarchy",
    f"""SELECT date, {_hierarchy("date")}, coalesce(n, 0) AS pipeline_runs FROM (
  SELECT CAST(unnest(generate_series(make_date(year(min(ts)), 1, 1), make_date(year(max(ts)), 12, 31),
         INTERVAL 1 DAY)) AS DATE) AS date FROM events)
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) ON day = date""",
)

# --- constraint checks


def _repeats(name: str, rows: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM "
        f"(SELECT {key} FROM {rows} GROUP BY {key} HAVING count(*) > 1)"
    )


_oracle(
    "chk_unique",
    " UNION ALL ".join(
        [
            _repeats("dim_customer", "key_customer", "customer_key"),
            _repeats("dim_product", "key_product", "product_key"),
            _repeats("dim_store", "key_store", "store_key"),
            _repeats("fact_sales", "sales", "order_item_id"),
            _repeats("fact_delivery", "delivered", "delivery_id"),
            _repeats("source_order_items", "raw_items", "order_item_id"),
        ]
    ),
)


def _dangling(name: str, rows: str, key: str, parents: str, parent_key: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM {rows} f "
        f"WHERE {key} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parents} p WHERE p.{parent_key} = f.{key})"
    )


_oracle(
    "chk_fk",
    " UNION ALL ".join(
        [
            _dangling("fact_sales_customer", "sales", "customer_id", "stg_customers", "customer_id"),
            _dangling("fact_sales_product", "sales", "product_id", "stg_products", "product_id"),
            _dangling("fact_sales_store", "sales", "store_id", "stg_stores", "store_id"),
            _dangling("fact_sales_channel", "sales", "sales_channel", "seed_channel", "channel_code"),
            _dangling("fact_sales_date", "sales", "order_date", "stg_orders", "order_date"),
            _dangling("fact_delivery_store", "delivered", "store_id", "stg_stores", "store_id"),
            _dangling(
                "source_orders_customer", "raw_orders", "customer_id", "ok_customers", "customer_id"
            ),
        ]
    ),
)


def _violations(rows: str, conditions: dict[str, str], table: str | None = None) -> str:
    head = f"'{table}' AS table_name, " if table else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{name}' AS check_name, count(*) FILTER (WHERE NOT coalesce({c}, TRUE)) "
        f"AS violations FROM {rows}"
        for name, c in conditions.items()
    )


_oracle(
    "chk_fact_sales",
    _violations(
        "sales",
        {
            "quantity_positive": "quantity > 0",
            **{
                f"{c}_not_negative": f"{c} >= 0"
                for c in (
                    "unit_price", "gross_amount", "discount_amount", "net_amount", "cost_amount",
                    "gross_amount_inr", "discount_amount_inr", "net_amount_inr", "cost_amount_inr",
                )
            },
        },
    )
    + " UNION ALL "
    + _violations(
        "delivered",
        {
            f"{c}_not_negative": f"{c} >= 0"
            for c in ("delivery_distance_km", "delivery_time_minutes", "delivery_fee")
        },
    ),
)
_oracle(
    "chk_dims",
    " UNION ALL ".join(
        [
            _violations(
                "norm_products",
                {
                    "unit_cost_not_negative": "unit_cost >= 0",
                    "selling_price_not_negative": "selling_price >= 0",
                    "product_rating_in_range": "product_rating BETWEEN 0 AND 5",
                },
                "dim_product",
            ),
            _violations(
                "norm_stores",
                {"store_type_allowed": f"store_type IN {_codes(C.STORE_TYPES)}"},
                "dim_store",
            ),
            _violations("norm_rates", {"rate_positive": "rate_to_inr > 0"}, "dim_currency"),
            _violations(
                "(SELECT DISTINCT order_date AS d FROM stg_orders)",
                {
                    "day_in_range": "day(d) BETWEEN 1 AND 31",
                    "month_in_range": "month(d) BETWEEN 1 AND 12",
                    "quarter_in_range": "quarter(d) BETWEEN 1 AND 4",
                },
                "dim_date",
            ),
        ]
    ),
)
_oracle(
    "chk_monitoring",
    _violations(
        "runs",
        {
            "status_allowed": f"status IN {_codes(C.RUN_STATUSES)}",
            **{
                f"records_{k}_not_negative": f"records_{k} >= 0"
                for k in ("extracted", "validated", "rejected", "loaded")
            },
            "quality_score_in_range": "quality_score BETWEEN 0 AND 100",
        },
    )
    + " UNION ALL "
    + _violations(
        "dq_log",
        {
            "checked_not_negative": "records_checked >= 0",
            "failed_within_checked": "records_failed BETWEEN 0 AND records_checked",
            "failure_rate_in_range": "failure_rate BETWEEN 0 AND 1",
        },
    ),
)


# --- checks over damaged rows
CTES["damaged"] = """
SELECT * REPLACE (CASE WHEN n = 3 THEN -quantity ELSE quantity END AS quantity,
  CASE WHEN n = 5 THEN -net_amount_inr ELSE net_amount_inr END AS net_amount_inr,
  CASE WHEN n = 7 THEN customer_id || '-gone' ELSE customer_id END AS customer_id,
  CASE WHEN n = 9 THEN DATE '1900-01-01' ELSE order_date END AS order_date)
FROM (SELECT *, CAST(substr(order_id, 5) AS BIGINT) % 17 AS n FROM sales) JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR n = 11"""
_oracle(
    "chk_damaged_facts",
    " UNION ALL ".join(
        [
            _repeats("fact_sales", "damaged", "order_item_id"),
            _dangling("fact_sales_customer", "damaged", "customer_id", "stg_customers", "customer_id"),
            _dangling("fact_sales_date", "damaged", "order_date", "stg_orders", "order_date"),
            _violations(
                "damaged",
                {
                    "quantity_positive": "quantity > 0",
                    **{
                        f"{c}_not_negative": f"{c} >= 0"
                        for c in (
                            "unit_price", "gross_amount", "discount_amount", "net_amount", "cost_amount",
                            "gross_amount_inr", "discount_amount_inr", "net_amount_inr", "cost_amount_inr",
                        )
                    },
                },
            ),
        ]
    ),
)
CTES["damaged_runs"] = """
SELECT * REPLACE (CASE WHEN run_id % 7 = 1 THEN 'DONE' ELSE status END AS status,
  CASE WHEN run_id % 7 = 2 THEN -1 ELSE records_loaded END AS records_loaded,
  CASE WHEN run_id % 7 = 3 THEN 100.5 ELSE quality_score END AS quality_score) FROM runs"""
_oracle(
    "chk_damaged_monitoring",
    _violations(
        "damaged_runs",
        {
            "status_allowed": f"status IN {_codes(C.RUN_STATUSES)}",
            **{
                f"records_{k}_not_negative": f"records_{k} >= 0"
                for k in ("extracted", "validated", "rejected", "loaded")
            },
            "quality_score_in_range": "quality_score BETWEEN 0 AND 100",
        },
    ),
)

# --- pages with a slicer set
_SHOWN = (
    ("category_performance", "m_category", "category", "sales"),
    ("channel_performance", "m_channel", "channel_name", "sales"),
    ("customer_performance", "m_customer", "customer_segment", "sales"),
    ("customer_performance", "m_customer", "country", "sales"),
    ("store_performance", "m_store", "store_type", "sales"),
    ("delivery_performance", "m_delivery", "delivery_status", "total_delivery_fee"),
)
_SLICED = {
    "category": ("m_category", "category IN ('ECONOMY', 'STANDARD')"),
    "channel": ("m_channel", "channel_name = 'Website'"),
    "segment": ("m_customer", "customer_segment IN ('VIP', 'NEW')"),
    "store_type": ("m_store", "store_type = 'DARK_STORE'"),
    "delivery_status": ("m_delivery", "delivery_status = 'DELIVERED'"),
}
for _slicer, (_sliced, _condition) in _SLICED.items():
    _oracle(
        f"rpt_sliced_{_slicer}",
        " UNION ALL ".join(
            f"SELECT '{mart}' AS mart, '{by}' AS shown_by, CAST({by} AS VARCHAR) AS member, {_sum(figure)} AS total "
            f"FROM {rows} WHERE {_condition if rows == _sliced else 'TRUE'} GROUP BY {by}"
            for mart, rows, by, figure in _SHOWN
        ),
    )
_oracle(
    "share_sliced_segment",
    f"""SELECT customer_segment, {_sum("sales")} AS sales,
  {_divide("sum(sales)", "(SELECT sum(sales) FROM m_customer WHERE country IN ('NATION_5', 'NATION_9', 'NATION_15'))")} AS segment_share
FROM m_customer WHERE country IN ('NATION_5', 'NATION_9', 'NATION_15') AND customer_segment IN ('VIP', 'NEW') GROUP BY customer_segment""",
)

# --- the whole flow: valid rows of the dirty sources in place of the staged ones
_VALID = {
    "customers": "SELECT * FROM ok_customers",
    "products": "SELECT * REPLACE (CAST(unit_cost AS DECIMAL(12,2)) AS unit_cost) FROM ok_products",
    "stores": "SELECT * FROM ok_stores",
    "orders": "SELECT *, _raw_id AS k FROM ok_orders",
    "items": """SELECT * REPLACE (CAST(quantity AS INTEGER) AS quantity, CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
  CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent) FROM ok_items""",
    "payments": "SELECT *, _raw_id AS raw_id FROM ok_payments",
    "deliveries": """SELECT * REPLACE (CAST(delivery_distance_km AS DECIMAL(10,2)) AS delivery_distance_km,
  CAST(delivery_time_minutes AS INTEGER) AS delivery_time_minutes, CAST(delivery_fee AS DECIMAL(12,2)) AS delivery_fee)
FROM ok_deliveries""",
    "rates": "SELECT * REPLACE (CAST(rate_to_inr AS DECIMAL(18,6)) AS rate_to_inr) FROM ok_rates",
}
_FLOW = (
    "newest_rates", "priced_orders", "line_money", "sales", "key_customer", "key_product", "key_store", "best_payment",
    "delivered", "m_monthly", "m_category", "m_product", "m_store", "m_channel", "m_customer", "m_delivery",
)


def _from_sources(sql: str) -> str:
    """The same statement over what is loaded from the dirty sources."""
    for name in _VALID:
        sql = re.sub(rf"\bstg_{name}\b", f"valid_{name}", sql)
    return re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(_FLOW)})\b", r"\1 e2e_\2", sql)


for _name, _sql in _VALID.items():
    CTES[f"valid_{_name}"] = _sql
for _name in _FLOW:
    CTES[f"e2e_{_name}"] = _from_sources(CTES[_name])
_oracle("e2e_fact_sales", _from_sources(_FACT_SALES))
_oracle("e2e_fact_delivery", _from_sources(_FACT_DELIVERY))
for _name in ("monthly", "category", "product", "store", "channel", "customer", "delivery"):
    _oracle(f"e2e_mart_{'monthly_sales' if _name == 'monthly' else _name}", f"SELECT * FROM e2e_m_{_name}")



# --- exact numbers
def _cents_of(amount: str, unit: int) -> str:
    """Whole cents of an amount in ``unit`` parts of a cent, halves to the even one."""
    whole, rest = f"(({amount}) // {unit})", f"(({amount}) % {unit})"
    return f"{whole} + CASE WHEN 2 * {rest} > {unit} OR (2 * {rest} = {unit} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"


CTES["eight_digits"] = """
SELECT *, CAST(units // 100000000 AS VARCHAR) || '.' || lpad(CAST(units % 100000000 AS VARCHAR), 8, '0') AS price
FROM (SELECT *, (CAST(round(l_extendedprice * 100) AS BIGINT) * 1000000) // CAST(l_quantity AS BIGINT) AS units FROM lineitem)"""
_oracle(
    "parse_decimal",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE (l_orderkey + l_linenumber) % 11 WHEN 3 THEN -exact WHEN 4 THEN exact * 100
    WHEN 0 THEN exact WHEN 1 THEN exact WHEN 2 THEN exact END AS parsed
FROM (SELECT *, CAST(price AS DECIMAL(38,18)) AS exact FROM eight_digits)""",
)
# Whole numbers throughout: ten-thousandths of a percent, hundred-millionths of money; halves go to the even cent.
_oracle(
    "line_amounts_exact",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, gross_amount, discount_amount,
  CAST(gross_amount - discount_amount AS DECIMAL(14,2)) AS net_amount, gross_amount AS cost_amount,
  CAST(-discount_amount AS DECIMAL(14,2)) AS profit_amount
FROM (SELECT *, CAST(CAST(({_cents_of("CAST(gross_amount * 100 AS HUGEINT) * percent", 1000000)}) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(14,2)) AS discount_amount
  FROM (SELECT *, l_orderkey % 100 * 10000 + l_partkey % 10000 AS percent,
    CAST(CAST(({_cents_of("CAST(l_quantity AS HUGEINT) * units", 1000000)}) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(14,2)) AS gross_amount
    FROM eight_digits))""",
)

# --- date spellings, by their place in the list: months stand for their first day, day.month.year is month first if it can be
_oracle(
    "parse_date_spellings",
    """SELECT o_orderkey, CAST(CASE WHEN n IN (14, 15) THEN NULL WHEN n BETWEEN 1 AND 4 THEN date_trunc('month', d)
  WHEN n = 9 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END AS DATE) AS parsed
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 16 AS n FROM orders)""",
)
