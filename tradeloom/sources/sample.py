"""The eight source tables and the run ledger, derived from the sample star schema.

``staged`` rows are typed and satisfy every rule.  ``source`` renders them as
text, as an extract would deliver them; its dirty variant carries defects at
positions fixed by the row's key, so that an independent engine can repeat
them.  ``_raw_id`` gives the arrival order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.contracts import (
    CHANNEL_CODES,
    CURRENCIES,
    CURRENCY_CODES,
    PAYMENT_METHOD_CODES,
    SOURCE_SCHEMAS,
    SOURCE_TABLES,
    STORE_TYPES,
)
from tradeloom.operators.joins import input_bytes, lookup_join
from tradeloom.session import cut_lineage

TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
SEGMENT_BY_MARKET = {
    "AUTOMOBILE": "NEW",
    "BUILDING": "REGULAR",
    "FURNITURE": "PREMIUM",
    "HOUSEHOLD": "VIP",
    "MACHINERY": "WHOLESALE",
}
CHANNEL_BY_PRIORITY = {
    "1-URGENT": "QUICK_COMMERCE",
    "2-HIGH": "MOBILE_APP",
    "3-MEDIUM": "WEBSITE",
    "4-NOT SPECIFIED": "PHYSICAL_STORE",
    "5-LOW": "WEBSITE",
}
#: Bytes of a file up to which it may be read by a few tasks only, so that its rows are dealt to all cores.
DEALT_INPUT_LIMIT = 16 * 1024 * 1024
STATUS_BY_FLAG = {"F": "DELIVERED", "O": "SHIPPED", "P": "PENDING"}


def _text(c: Column) -> Column:
    return c.cast("string")


def _lookup(c: Column, pairs: dict[str, str]) -> Column:
    entries = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.element_at(F.create_map(*entries), c)


def _pick(options: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in options]), (index % len(options) + 1).cast("int"))


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def _whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _from_cents(cents: Column) -> Column:
    return cents.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(3,2)")


def _every(n: int, offset: int = 0) -> Column:
    return F.col("_key") % n == offset


def _formatted(name: str, pattern: str) -> Column:
    return F.date_format(name, pattern)


def _compact_day(name: str) -> Column:
    """``yyyyMMdd``, from the date's numbers where the year has four digits."""
    digits = (F.year(name) * 10000 + F.month(name) * 100 + F.dayofmonth(name)).cast("string")
    return F.when(F.year(name).between(1000, 9999), digits).otherwise(_formatted(name, "yyyyMMdd"))


@dataclass(frozen=True)
class Defects:
    """Which rows arrive twice, and what replaces a column's text where."""

    cases: dict[str, list[tuple[Column, Column]]] = field(default_factory=dict)
    repeated: Column | None = None


class LazyFrames(Mapping):
    """Named frames whose plans are only built when they are asked for."""

    def __init__(self, names: tuple[str, ...], build: Callable[[str], DataFrame]):
        self._names = names
        self._build = build
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._names:
                raise KeyError(name)
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class SampleSources:
    """Lazy frames over one directory of sample tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}
        self._volumes: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """A sample table, as Spark reads it at every size."""
        if name not in self._tables:
            reader = self.spark.read.schema(TABLE_SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    def staged(self, name: str) -> DataFrame:
        """Typed, valid rows of a source."""
        return self._rows(name).select("_raw_id", *SOURCE_SCHEMAS[name])

    def source(self, name: str, dirty: bool = False) -> DataFrame:
        """The same rows as text; the dirty variant adds defects and repeats."""
        rows = self._dealt(self._rows(name, dirty))
        text = {c: F.col(c).cast("string") for c in SOURCE_SCHEMAS[name]}
        if dirty:
            defects: Defects = getattr(self, f"_{name}_defects")()
            if defects.repeated is not None:
                once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
                copies = F.explode(F.when(defects.repeated, twice).otherwise(once))
                rows = rows.withColumn("_copy", copies).withColumn(
                    "_raw_id", F.col("_raw_id") + F.col("_copy") - 1
                )
            for column, cases in defects.cases.items():
                changed = None
                for where, value in cases:
                    changed = F.when(where, value) if changed is None else changed.when(where, value)
                text[column] = changed.otherwise(text[column])
        return rows.select("_raw_id", *[c.alias(n) for n, c in text.items()])

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows of a small file on all cores: one row group is one task, but its rows are costly to render and judge."""
        size = input_bytes(rows)
        if size is None or size > DEALT_INPUT_LIMIT:
            return rows
        return rows.repartition(self.spark.sparkContext.defaultParallelism, "_key")

    def staged_tables(self) -> LazyFrames:
        return LazyFrames(SOURCE_TABLES, self.staged)

    def dated_tables(self) -> LazyFrames:
        """The staged tables with rates quoted on every calendar day, for what lists the days of the data."""
        rates = lambda: self._exchange_rates(every_day=True).select("_raw_id", *SOURCE_SCHEMAS["exchange_rates"])
        return LazyFrames(SOURCE_TABLES, lambda name: rates() if name == "exchange_rates" else self.staged(name))

    def sources(self, dirty: bool = False) -> LazyFrames:
        return LazyFrames(SOURCE_TABLES, lambda name: self.source(name, dirty))

    def _rows(self, name: str, dirty: bool = False) -> DataFrame:
        if name == "order_items":
            return self._order_items(short_ids=dirty)
        return getattr(self, f"_{name}")()

    def order_days(self) -> DataFrame:
        """Every calendar day from the first to the last order date."""
        day = self.order_volumes()
        first, last = day.agg(F.min("day")).scalar(), day.agg(F.max("day")).scalar()
        return self.spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))

    def order_volumes(self) -> DataFrame:
        """Per order date its number of orders: one pass over the orders, written once, as many frames start from it."""
        if self._volumes is None:
            day = self.table("orders").where("o_orderdate IS NOT NULL").groupBy(F.to_date("o_orderdate").alias("day"))
            self._volumes = cut_lineage(day.agg(F.count(F.lit(1)).alias("orders")), "order_volumes")
        return self._volumes

    def _places(self) -> DataFrame:
        regions = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return lookup_join(self.table("nation"), regions, "n_regionkey").select(
            "n_nationkey", "n_name", "r_name"
        )

    def _customers(self) -> DataFrame:
        k = F.col("c_custkey")
        parts = F.split("c_name", "#")
        first, last = F.element_at(parts, 1), F.element_at(parts, 2)
        places = self._places().withColumnRenamed("n_nationkey", "c_nationkey")
        return lookup_join(self.table("customer"), places, "c_nationkey").select(
            k.alias("_key"),
            (k * 2 + 1).alias("_raw_id"),
            F.concat(F.lit("CUST-"), _text(k)).alias("customer_id"),
            first.alias("first_name"),
            last.alias("last_name"),
            F.concat(F.lower(first), last, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+91-"), F.lpad(_text(k), 10, "0")).alias("phone"),
            F.concat(F.lit("City "), _text(F.col("c_nationkey"))).alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("country"),
            _lookup(F.col("c_mktsegment"), SEGMENT_BY_MARKET).alias("customer_segment"),
            F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int")).alias("signup_date"),
        )

    def _customers_defects(self) -> Defects:
        email, city, country, day = F.col("email"), F.col("city"), F.col("country"), "signup_date"
        return Defects(
            {
                "email": [
                    (_every(97), F.lit("")),
                    (_every(89, 1), F.replace(email, F.lit("@"), F.lit(" at "))),
                ],
                "city": [
                    (F.col("_copy") == 2, F.lit("Second copy")),
                    (_every(67, 3), F.replace(city, F.lit(" "), F.lit(" \t "))),
                ],
                "country": [(_every(61, 2), F.concat(F.lit("  "), country, F.lit("\n")))],
                "customer_segment": [
                    (_every(53), F.lower("customer_segment")),
                    (_every(103, 5), F.lit("GOLD")),
                ],
                day: [
                    (_every(101), F.lit("2020-02-30")),
                    (_every(43, 1), _formatted(day, "MM/dd/yyyy")),
                    (_every(47, 2), _formatted(day, "dd-MMM-yyyy")),
                    (_every(41, 3), _formatted(day, "yyyyMMdd")),
                    (_every(37, 4), _formatted(day, "MMM d, yyyy")),
                    (_every(59, 5), F.concat(F.col(day).cast("string"), F.lit(" 10:30:00"))),
                ],
            },
            repeated=_every(113),
        )

    def _products(self) -> DataFrame:
        k = F.col("p_partkey")
        price = _cents(F.col("p_retailprice"))
        return self.table("part").select(
            k.alias("_key"),
            (k + 1).alias("_raw_id"),
            F.concat(F.lit("PRD-"), _text(k)).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("SIZE-"), _text(F.col("p_size"))).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.concat(F.lit("Vendor "), _text(F.col("p_size"))).alias("supplier"),
            _from_cents(_whole(price * 7, F.lit(10))).alias("unit_cost"),
            _from_cents(price).alias("selling_price"),
            ((k % 51).cast("decimal(2,0)") * F.lit("0.1").cast("decimal(2,1)")).alias(
                "product_rating"
            ),
        )

    def _products_defects(self) -> Defects:
        category, cost, price = F.col("category"), F.col("unit_cost"), F.col("selling_price")
        return Defects(
            {
                "category": [
                    (_every(61, 2), F.concat(F.lit(" "), category, F.lit("\t"))),
                    (_every(131, 7), F.lit("   ")),
                ],
                "unit_cost": [
                    (_every(199, 1), _text(price + cost)),
                    (_every(103, 6), F.lit("")),
                    (_every(139, 8), F.lit("-5")),
                ],
                "selling_price": [
                    (_every(211), F.concat(F.lit("-"), _text(price))),
                    (_every(97, 4), F.lit("1,000")),
                    (_every(89, 5), F.lit(" 1.5e3 ")),
                ],
                "product_rating": [(_every(83, 3), F.lit("n/a"))],
            }
        )

    def _stores(self) -> DataFrame:
        k, n = F.col("s_suppkey"), F.col("s_nationkey")
        places = self._places().withColumnRenamed("n_nationkey", "s_nationkey")
        return lookup_join(self.table("supplier"), places, "s_nationkey").select(
            k.alias("_key"),
            (k + 1).alias("_raw_id"),
            F.concat(F.lit("STR-"), _text(k)).alias("store_id"),
            F.col("s_name").alias("store_name"),
            _pick(STORE_TYPES, k).alias("store_type"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("City "), _text(n)).alias("city"),
            (n * 7 - 85).alias("latitude"),
            (n * 14 - 170).alias("longitude"),
            F.date_add(F.lit("1985-01-01").cast("date"), (k % 3650).cast("int")).alias(
                "opening_date"
            ),
        )

    def _stores_defects(self) -> Defects:
        return Defects(
            {
                "store_type": [(_every(37, 1), F.lit("STORE"))],
                "latitude": [(_every(41, 2), F.lit("95.5"))],
                "longitude": [(_every(47, 7), F.lit("east"))],
                "opening_date": [(_every(43, 3), F.lit("not-a-date"))],
            }
        )

    def _order_facts(self) -> DataFrame:
        """Order attributes that orders, payments and deliveries share."""
        k = F.col("o_orderkey")
        stores = self.table("supplier").agg(F.count("*")).scalar()
        return self.table("orders").select(
            k.alias("_key"),
            F.concat(F.lit("ORD-"), _text(k)).alias("order_id"),
            F.concat(F.lit("CUST-"), _text(F.col("o_custkey"))).alias("customer_id"),
            F.concat(F.lit("STR-"), _text(k % stores)).alias("store_id"),
            F.to_date("o_orderdate").alias("order_date"),
            _lookup(F.col("o_orderpriority"), CHANNEL_BY_PRIORITY).alias("sales_channel"),
            _lookup(F.col("o_orderstatus"), STATUS_BY_FLAG).alias("order_status"),
            _pick(CURRENCY_CODES, F.col("o_custkey")).alias("currency"),
            _from_cents(_cents(F.col("o_totalprice"))).alias("order_total"),
        )

    def _orders(self) -> DataFrame:
        return self._order_facts().withColumn("_raw_id", F.col("_key") * 2 + 1)

    def _orders_defects(self) -> Defects:
        channel = F.concat(F.lit(" "), F.lower("sales_channel"), F.lit("  "))
        return Defects(
            {
                "customer_id": [(_every(83), F.concat(F.lit("CUST-X"), _text(F.col("_key"))))],
                "store_id": [(_every(89, 1), F.lit("STR-X"))],
                "order_date": [
                    (_every(101, 2), F.lit("1998-13-45")),
                    (_every(17, 3), _formatted("order_date", "yyyyMMdd")),
                ],
                "sales_channel": [(_every(71, 4), channel), (_every(107, 5), F.lit("FAX"))],
                "order_status": [(_every(67, 6), F.lit("SHIPED"))],
                "currency": [(_every(79), F.lit("XXX")), (_every(29, 7), F.lower("currency"))],
                "order_total": [(_every(73, 8), F.lit("-1.0"))],
            },
            repeated=_every(127),
        )

    def _order_items(self, short_ids: bool) -> DataFrame:
        """Order lines; short ids (order and line number) do repeat in the sample."""
        order, line = F.col("l_orderkey"), F.col("l_linenumber")
        quantity = F.col("l_quantity").cast("bigint")
        cents = _cents(F.col("l_extendedprice"))
        # Unit price in cents, half up, in integer arithmetic.
        price = _from_cents(_whole(cents * 2 + quantity, quantity * 2))
        shipped = _compact_day("l_shipdate")
        item = F.concat_ws("-", F.lit("ITEM"), order, line)
        if not short_ids:
            item = F.concat_ws("-", item, "l_partkey", "l_suppkey", cents, shipped)
        arrival = F.struct(
            "l_partkey", "l_suppkey", cents.alias("cents"), shipped.alias("shipped")
        )
        return self.table("lineitem").withColumn("l_shipdate", F.to_date("l_shipdate")).select(
            (order + line).alias("_key"),
            arrival.alias("_raw_id"),
            item.alias("order_item_id"),
            F.concat(F.lit("ORD-"), _text(order)).alias("order_id"),
            F.concat(F.lit("PRD-"), _text(F.col("l_partkey"))).alias("product_id"),
            quantity.cast("int").alias("quantity"),
            price.cast("decimal(12,2)").alias("unit_price"),
            F.round(F.col("l_discount") * 100).cast("decimal(5,0)").alias("discount_percent"),
        )

    def _order_items_defects(self) -> Defects:
        return Defects(
            {
                "product_id": [(_every(109, 1), F.lit("PRD-X"))],
                "quantity": [
                    (_every(67), F.lit("0")),
                    (_every(97, 2), F.lit("2.5")),
                    (_every(103, 3), F.lit("two")),
                ],
                "unit_price": [
                    (_every(71, 4), F.lit("-9.99")),
                    (_every(113, 5), F.lit("0.0")),
                ],
                "discount_percent": [(_every(83, 6), F.lit("150"))],
            }
        )

    def _payments(self) -> DataFrame:
        """One attempt per order; some first attempts fail and are repeated a day later."""
        k, attempt = F.col("_key"), F.col("attempt")
        attempts = F.when(_every(16), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        status = (
            F.when(_every(16), F.when(attempt == 1, "FAILED").otherwise("SUCCESS"))
            .when(F.col("order_status") == "PENDING", "PENDING")
            .otherwise("SUCCESS")
        )
        return (
            self._order_facts()
            .withColumn("attempt", F.explode(attempts))
            .select(
                "_key",
                (k * 2 + attempt).alias("_raw_id"),
                F.concat_ws("-", F.lit("PAY"), k, attempt).alias("payment_id"),
                "order_id",
                _pick(PAYMENT_METHOD_CODES, k + attempt).alias("payment_method"),
                status.alias("payment_status"),
                F.col("order_total").alias("payment_amount"),
                F.date_add("order_date", attempt - 1).alias("payment_date"),
                "currency",
            )
        )

    def _payments_defects(self) -> Defects:
        return Defects(
            {
                "payment_method": [(_every(97, 1), F.lit("CHEQUE"))],
                "payment_status": [(_every(73, 2), F.lit("OK"))],
                "payment_amount": [(_every(61, 3), F.lit(""))],
                "payment_date": [(_every(89, 4), F.lit("soon"))],
                "currency": [(_every(79, 5), F.lit("EURO"))],
            }
        )

    def _deliveries(self) -> DataFrame:
        """Every order that is not carried out of a shop."""
        k, channel = F.col("_key"), F.col("sales_channel")
        kind = (
            F.when(channel == "QUICK_COMMERCE", "QUICK")
            .when(channel == "MOBILE_APP", "EXPRESS")
            .otherwise("STANDARD")
        )
        progress = {"DELIVERED": "DELIVERED", "SHIPPED": "IN_TRANSIT", "PENDING": "ASSIGNED"}
        status = (
            F.when(_every(19), "FAILED")
            .when(_every(23), "CANCELLED")
            .otherwise(_lookup(F.col("order_status"), progress))
        )
        return (
            self._order_facts()
            .filter(channel != "PHYSICAL_STORE")
            .select(
                "_key",
                (k + 1).alias("_raw_id"),
                F.concat(F.lit("DEL-"), _text(k)).alias("delivery_id"),
                "order_id",
                "store_id",
                kind.alias("delivery_type"),
                status.alias("delivery_status"),
                _from_cents(k * 37 % 5000).alias("delivery_distance_km"),
                (k * 13 % 2880).cast("int").alias("delivery_time_minutes"),
                _from_cents(k * 17 % 3000).alias("delivery_fee"),
            )
        )

    def _deliveries_defects(self) -> Defects:
        return Defects(
            {
                "store_id": [(_every(89, 2), F.lit("STR-X"))],
                "delivery_type": [(_every(61, 3), F.lit("DRONE"))],
                "delivery_status": [(_every(67, 4), F.lit("LOST"))],
                "delivery_distance_km": [(_every(71, 5), F.lit("far"))],
                "delivery_time_minutes": [
                    (_every(59), F.lit("-15")),
                    (_every(97, 6), F.lit("999999")),
                ],
                "delivery_fee": [(_every(103, 7), F.lit("-2.50"))],
            }
        )

    def _exchange_rates(self, every_day: bool = False) -> DataFrame:
        """A rate per weekday with orders and currency, which follows the day's orders; NZD is only quoted on Mondays.

        ``every_day``: the days without orders between the first and the last one have theirs, too.
        """
        days = self.order_volumes()
        if every_day:
            days = self.order_days().join(days, "day", "left").fillna(0, "orders")
        quotes = F.array(
            *[
                F.struct(
                    F.lit(row[0]).alias("key"),
                    F.lit(row[1]).alias("code"),
                    F.lit(row[4]).cast("decimal(6,2)").alias("seed"),
                )
                for row in CURRENCIES
            ]
        )
        key, code = F.col("q.key"), F.col("q.code")
        permille = ((F.col("orders") + F.dayofyear("day") + key) % 21 + 990).cast("decimal(4,0)")
        rate = F.col("q.seed") * (permille * F.lit("0.001").cast("decimal(4,3)"))
        base = code == "INR"
        quoted = base | ((F.weekday("day") < 5) & ((code != "NZD") | (F.weekday("day") == 0)))
        day_number = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")).cast("bigint")
        return (
            days.withColumn("q", F.explode(quotes))
            .filter(quoted)
            .select(
                F.dayofmonth("day").alias("_key"),
                (day_number * 100 + key * 2).alias("_raw_id"),
                F.col("day").alias("rate_date"),
                code.alias("currency_code"),
                F.when(base, F.lit(1)).otherwise(rate).cast("decimal(12,5)").alias("rate_to_inr"),
            )
        )

    def _exchange_rates_defects(self) -> Defects:
        day, code = F.col("_key"), F.col("currency_code")
        return Defects(
            {
                "rate_date": [((day == 30) & (code == "GBP"), F.lit("bad"))],
                "currency_code": [
                    ((day == 21) & (code == "EUR"), F.lit("EURO")),
                    ((day == 22) & (code == "EUR"), F.lit(" eur ")),
                ],
                "rate_to_inr": [
                    (F.col("_copy") == 2, F.lit("90.25")),
                    ((day == 13) & (code == "INR"), F.lit("1.05")),
                    ((day == 28) & (code == "JPY"), F.lit("0")),
                ],
            },
            repeated=(day == 7) & (code == "USD"),
        )

    def run_events(self) -> DataFrame:
        """Ledger events: every event row starts a run, all but clicks also finish it."""
        e = self.table("events")
        extracted = F.col("event_id") % 1000 + 100
        rejected = F.col("user_id") % 7
        done = F.struct(
            F.lit("FINISH").alias("event"),
            (
                F.unix_micros(F.col("ts").cast("timestamp")) + _cents(F.col("value")) * 10000
            ).alias("micros"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        )
        begun = F.struct(
            F.lit("START").alias("event"),
            F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
            F.lit("RUNNING").alias("status"),
        )
        finished = F.col("step.event") == "FINISH"
        failed = F.col("step.status") == "FAILED"
        score = (
            (extracted - rejected).cast("double") / extracted.cast("double") * F.lit(100.0)
        ).cast("decimal(5,2)")
        return e.withColumn(
            "step",
            F.explode(
                F.when(F.col("event_type") == "click", F.array(begun)).otherwise(
                    F.array(begun, done)
                )
            ),
        ).select(
            F.col("event_id").alias("run_id"),
            F.lit("retail_batch").alias("pipeline_name"),
            F.col("step.event").alias("event"),
            F.timestamp_micros("step.micros").alias("event_ts"),
            F.col("step.status").alias("status"),
            F.when(finished, extracted).alias("records_extracted"),
            F.when(finished, extracted - rejected).alias("records_validated"),
            F.when(finished, rejected).alias("records_rejected"),
            F.when(finished, F.when(failed, F.lit(0)).otherwise(extracted - rejected))
            .cast("bigint")
            .alias("records_loaded"),
            F.when(finished, score).alias("quality_score"),
            F.when(finished & failed, F.concat(F.lit("user "), _text(F.col("user_id")))).alias(
                "error_message"
            ),
        )

    def dq_results(self) -> DataFrame:
        """One rule row and one overall row per finished run."""
        e = self.table("events").filter(F.col("event_type") != "click")
        checked = (F.col("event_id") % 1000 + 100).cast("bigint")
        failed = (F.col("user_id") % 7).cast("bigint")
        table_name = _pick(SOURCE_TABLES, F.col("user_id"))
        rules = F.array(
            F.concat(F.lit("rule_"), F.col("event_type")), F.lit("overall_table_quality")
        )
        return e.select(
            F.col("event_id").alias("run_id"),
            table_name.alias("table_name"),
            F.explode(rules).alias("rule_name"),
            checked.alias("records_checked"),
            failed.alias("records_failed"),
            (failed.cast("double") / checked.cast("double")).cast("decimal(7,4)").alias(
                "failure_rate"
            ),
            F.timestamp_micros(
                F.unix_micros(F.col("ts").cast("timestamp")) + _cents(F.col("value")) * 10000
            ).alias("created_at"),
        )
