"""Every operator as a named query over a directory of sample tables.

Each query reads the given tables through ``SampleSources`` and returns a
DataFrame; those that read an intermediate several times write it first.
Sources are whole tables; validation queries use the dirty variants, warehouse
and reporting queries the clean ones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom import contracts as C
from tradeloom.functions.dates import calendar_columns, date_key, hierarchy_columns
from tradeloom.functions.parse import parse_date, parse_decimal, parse_numeric
from tradeloom.functions.text import norm_code, norm_text
from tradeloom.operators import checks, dims, facts, fx, landing, rejects, validate
from tradeloom.operators.amounts import order_totals, with_line_amounts
from tradeloom.operators.keys import dense_keys
from tradeloom.operators.merge import upsert
from tradeloom.operators.monitoring import ledger_state
from tradeloom.operators.payments import payment_by_order
from tradeloom.operators.rules import SPECS
from tradeloom.plans import filters, marts, measures, reports
from tradeloom.session import configure, cut_lineage, scratch, work_dir
from tradeloom.sources.sample import LazyFrames, SampleSources
from tradeloom.sources.tables import MonthlyTable, with_row_ids

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Sample:
    """Lazy frames shared by the queries of one sample directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = configure(spark)
        self.tables = SampleSources(spark, directory)

    @cached_property
    def dirty(self) -> LazyFrames:
        return self.tables.sources(dirty=True)

    @cached_property
    def clean(self) -> LazyFrames:
        """Typed rows as staging holds them; every one of them is valid."""
        return self.tables.staged_tables()

    def tagged(self, name: str) -> DataFrame:
        return validate.tagged_table(name, self.dirty)

    @cached_property
    def all_tagged(self) -> dict[str, DataFrame]:
        """All tables; orders, which three others refer to, are validated once."""
        return validate.validate_all(
            self.dirty, keep=lambda name, df: cut_lineage(df) if name == "orders" else df
        )

    @cached_property
    def dq(self) -> DataFrame:
        return validate.dq_rows(self.all_tagged)

    @cached_property
    def keyed(self) -> LazyFrames:
        return LazyFrames(tuple(dims.DIM_KEYS), lambda n: dims.keyed_dimension(n, self.clean))

    @cached_property
    def star(self) -> LazyFrames:
        """Dimensions keyed by business id, plus the calendar of the order dates."""
        build = {
            "dim_date": self._calendar,
            "dim_channel": lambda: dims.dim_channel(self.spark),
        }
        return LazyFrames(
            (*dims.DIM_KEYS, *build),
            lambda n: build[n]() if n in build else dims.naturally_keyed_dimension(n, self.clean),
        )

    def _calendar(self) -> DataFrame:
        return self.tables.order_days().select(*calendar_columns(F.col("day")))

    @cached_property
    def lines(self) -> DataFrame:
        return facts.sales_lines(self.clean, self.star, with_payment=False)

    def mart(self, name: str) -> DataFrame:
        if name == "delivery_performance":
            return marts.delivery_mart(facts.delivery_events(self.clean, self.star), self.star)
        lines = facts.sales_lines(
            self.clean, self.star, with_payment=False, carry=marts.carried(name)
        )
        return marts.summarise_lines(name, lines)

    def marts(self, *names: str) -> DataFrame:
        """Several sales marts from one pass over the lines."""
        star, carry = marts.with_carried(self.star, names)
        return marts.all_sales_marts(facts.sales_lines(self.clean, star, with_payment=False, carry=carry), names)

    @cached_property
    def loaded(self) -> Loaded:
        return Loaded(self)

    @cached_property
    def runs(self) -> DataFrame:
        return ledger_state(self.tables.run_events())

    @cached_property
    def dq_history(self) -> DataFrame:
        return self.tables.dq_results()


class Loaded:
    """The star that the batch loads from the dirty sources; every table is written when it is first read."""

    def __init__(self, sample: Sample):
        self.spark, self.sources = sample.spark, sample.dirty

    @cached_property
    def valid(self) -> dict[str, DataFrame]:
        tagged = validate.validate_all(self.sources, keep=self._kept)
        return {name: validate.valid_rows(df) for name, df in tagged.items()}

    @staticmethod
    def _kept(name: str, df: DataFrame) -> DataFrame:
        """A tagged table as written; like a staging table, without the arrival order unless a later step goes by it."""
        return cut_lineage(df if name in ("payments", "exchange_rates") else df.drop("_raw_id"), name)

    @cached_property
    def dimensions(self) -> LazyFrames:
        seeds = {"dim_channel": dims.dim_channel, "dim_date": lambda spark: dims.dim_date(spark, self.valid)}
        build = lambda n: seeds[n](self.spark) if n in seeds else dims.keyed_dimension(n, self.valid)
        return LazyFrames((*dims.DIM_KEYS, *seeds), build)

    def fact(self, name: str) -> DataFrame:
        build = {"fact_sales": facts.fact_sales, "fact_delivery": facts.fact_delivery}[name]
        return build(self.valid, self.dimensions)

    def mart(self, name: str) -> DataFrame:
        """A mart as a reader of the loaded star gets it, by surrogate keys."""
        if name == "delivery_performance":
            return marts.delivery_mart(cut_lineage(self.fact("fact_delivery"), "fact"), self.dimensions)
        return marts.sales_mart(name, cut_lineage(self.fact("fact_sales"), "fact"), self.dimensions)


def _register(name: str, build: Callable[[Sample], DataFrame]) -> None:
    QUERIES[name] = lambda spark, directory: build(Sample(spark, directory))


def query(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    """Register a builder under its function name."""
    _register(build.__name__, build)
    return build


# --- landing ---------------------------------------------------------------


@query
def extract_counts(s: Sample) -> DataFrame:
    return landing.extract_counts(s.dirty)


@query
def raw_landing(s: Sample) -> DataFrame:
    return landing.raw_rows("orders", s.dirty["orders"]).drop("_ingested_at")


@query
def staging_orders(s: Sample) -> DataFrame:
    valid = validate.valid_rows(s.tagged("orders"))
    return landing.staging_rows("orders", valid).drop("_processed_at")


@query
def staging_order_items(s: Sample) -> DataFrame:
    valid = validate.valid_rows(s.tagged("order_items"))
    return landing.staging_rows("order_items", valid).drop("_processed_at")


@query
def seed_if_absent(s: Sample) -> DataFrame:
    """Days already loaded from the event log keep their row; the calendar fills the rest."""
    days = s.tables.table("events").select(F.to_date("ts").alias("d")).distinct()
    loaded = days.select(*calendar_columns(F.col("d"))).withColumn("day_name", F.lit("LOADED"))
    return dims.seeded(loaded, dims.calendar_seed(s.spark), "date_key").select(
        "date_key", "full_date", "day_name", "year"
    )


# --- scalars ---------------------------------------------------------------


def _norm_text(s: Sample) -> DataFrame:
    return s.dirty["customers"].select(
        "_raw_id",
        norm_text(F.col("city")).alias("city"),
        norm_text(F.col("country")).alias("country"),
        norm_text(F.col("email")).alias("email"),
    )


_register("norm_text", _norm_text)


def _norm_code(s: Sample) -> DataFrame:
    return s.dirty["orders"].select(
        "_raw_id",
        norm_code(F.col("sales_channel")).alias("sales_channel"),
        norm_code(F.col("currency")).alias("currency"),
    )


_register("norm_code", _norm_code)


def _spelling(selector: Column, spellings: list[Column]) -> Column:
    """One of several spellings of a value, by the row's key."""
    choice = (selector % len(spellings) + 1).cast("int")
    return F.element_at(F.array(*spellings), choice)


def _parse_numeric(s: Sample) -> DataFrame:
    q = F.col("l_quantity").cast("int").cast("string")
    spellings = [
        q,
        F.concat(F.lit("  "), q, F.lit(" ")),
        F.concat(F.lit("+"), q),
        F.concat(F.lit("-"), q, F.lit(".25")),
        F.concat(q, F.lit("e2")),
        F.concat(q, F.lit("d")),
        F.concat(q, F.lit(",000")),
        F.concat(q, F.lit("_0")),
        F.lit("nan"),
        F.lit(""),
        F.lit("0x1A"),
        F.concat(F.lit("."), q),
    ]
    mark = F.col("l_orderkey") + F.col("l_linenumber")
    return s.tables.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        parse_numeric(_spelling(mark, spellings)).alias("parsed"),
    )


_register("parse_numeric", _parse_numeric)


def _parse_decimal(s: Sample) -> DataFrame:
    """The parser that the rules call, on prices of eight digits behind the point and on what is no number."""
    price = _eight_digit_price()
    spellings = [
        price,
        F.concat(F.lit("  "), price, F.lit(" ")),
        F.concat(F.lit("+"), price),
        F.concat(F.lit("-"), price),
        F.concat(price, F.lit("e2")),
        F.concat(price, F.lit("d")),
        F.concat(F.lit("1,"), price),
        F.lit("nan"),
        F.lit("inf"),
        F.lit(""),
        F.lit("0x1A"),
    ]
    parsed = parse_decimal(_spelling(F.col("l_orderkey") + F.col("l_linenumber"), spellings))
    return s.tables.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parsed.alias("parsed"))


def _eight_digit_price() -> Column:
    """A line's extended price over its quantity as text, cut after eight digits behind the point."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    units = F.call_function("div", cents * 1_000_000, F.col("l_quantity").cast("bigint"))
    whole, rest = F.call_function("div", units, F.lit(100_000_000)), units % 100_000_000
    return F.concat(whole.cast("string"), F.lit("."), F.lpad(rest.cast("string"), 8, "0"))


_register("parse_decimal", _parse_decimal)


def _parse_date(s: Sample) -> DataFrame:
    d = F.to_date("o_orderdate")
    formats = [
        "yyyy-MM-dd",
        "yyyyMMdd",
        "MM/dd/yyyy",
        "dd/MM/yyyy",
        "MMM d yyyy",
        "MMMM d, yyyy",
        "d-MMM-yyyy",
        "yyyy-M-d",
        "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy",
        "yyyy-MM-dd 'later'",
        "yyyy-02-30",
        "yyyy/MM/dd",
    ]
    text = _spelling(F.col("o_orderkey"), [F.date_format(d, f) for f in formats])
    return s.tables.table("orders").select("o_orderkey", parse_date(text).alias("parsed"))


_register("parse_date", _parse_date)


@query
def parse_date_spellings(s: Sample) -> DataFrame:
    """Short years, months alone, weekdays and clock times around a date, and what is no date."""
    d = F.to_date("o_orderdate")
    formats = [
        "MM/dd/yy",
        "yyyy/MM",
        "yyyy-MM",
        "MMM yyyy",
        "MMMM yyyy",
        "EEEE, d MMMM yyyy",
        "EEE d MMM yyyy",
        "yyyy MMM d",
        "yyyy-MM-dd HH:mm",
        "dd.MM.yyyy HH:mm:ss",
        "MM/dd/yyyy hh:mm a",
        "yyyyMMddHHmmss",
        "MMM. d, yyyy",
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
        "'today'",
        "HH:mm",
    ]
    text = _spelling(F.col("o_orderkey"), [F.date_format(d, f) for f in formats])
    return s.tables.table("orders").select("o_orderkey", parse_date(text).alias("parsed"))


def _date_key(s: Sample) -> DataFrame:
    return s.clean["orders"].select("order_id", date_key(F.col("order_date")).alias("date_key"))


_register("date_key", _date_key)


# --- validation ------------------------------------------------------------


@query
def first_failed_rule(s: Sample) -> DataFrame:
    rejected = validate.rejected_rows(SPECS["orders"], s.tagged("orders"))
    return rejected.select("_raw_id", "record_identifier", "failed_rule", "rejection_reason")


@query
def dq_rule_counts(s: Sample) -> DataFrame:
    return s.dq.filter(F.col("rule_name") != C.OVERALL_RULE).select(
        "table_name", "rule_name", "records_checked", "records_failed"
    )


@query
def valid_customers(s: Sample) -> DataFrame:
    return validate.valid_rows(s.tagged("customers"))


@query
def orphan_orders(s: Sample) -> DataFrame:
    orders = validate.normalise(SPECS["orders"], s.dirty["orders"])
    customers = validate.valid_rows(s.tagged("customers")).select("customer_id")
    return orders.select("_raw_id", "order_id", "customer_id").join(
        customers, "customer_id", "left_anti"
    )


@query
def quality_scores(s: Sample) -> DataFrame:
    return validate.quality_scores(s.dq)


@query
def quality_gate(s: Sample) -> DataFrame:
    return validate.overall_score(validate.quality_scores(s.dq))


@query
def dq_results(s: Sample) -> DataFrame:
    return s.dq


@query
def run_ledger_state(s: Sample) -> DataFrame:
    return s.runs


def _rules(table: str) -> Callable[[Sample], DataFrame]:
    return lambda s: validate.rule_counts(SPECS[table], s.tagged(table))


for _table in C.SOURCE_TABLES:
    _register(f"rules_{_table}", _rules(_table))


@query
def rejects_customers(s: Sample) -> DataFrame:
    return rejects.reject_rows(SPECS["customers"], s.tagged("customers"), run_id=1)


@query
def rejects_exchange_rates(s: Sample) -> DataFrame:
    return rejects.reject_rows(SPECS["exchange_rates"], s.tagged("exchange_rates"), run_id=1)


# --- amounts and rates -----------------------------------------------------

_LINE = ("source_order_item_id", "quantity", "unit_price")
_AMOUNTS = ("gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount")


@query
def line_amounts(s: Sample) -> DataFrame:
    return s.lines.select(*_LINE, *_AMOUNTS)


@query
def line_amounts_inr(s: Sample) -> DataFrame:
    return s.lines.select(
        "source_order_item_id", "fx_rate", "unit_price_inr", *[f"{a}_inr" for a in _AMOUNTS]
    )


@query
def line_amounts_exact(s: Sample) -> DataFrame:
    """Amounts of prices with eight digits and discounts with four, as the load computes them from text."""
    lines = s.tables.table("lineitem")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    spec = SPECS["order_items"]
    discount = F.concat((F.col("l_orderkey") % 100).cast("string"), F.lit("."), F.lpad((F.col("l_partkey") % 10_000).cast("string"), 4, "0"))
    text = lines.select(
        *key,
        F.lit(0).alias("_raw_id"),
        *[F.lit("x").alias(c) for c in ("order_item_id", "order_id", "product_id")],
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
        _eight_digit_price().alias("unit_price"),
        discount.alias("discount_percent"),
    )
    parsed = text.withColumns({c: parse_decimal(F.col(c)) for c in ("quantity", "unit_price", "discount_percent")})
    working = {
        "quantity": F.col("quantity").cast("int"),
        "unit_price": F.col("unit_price").try_cast(validate.working_type(C.SOURCE_SCHEMAS[spec.name]["unit_price"])),
        "discount_percent": F.col("discount_percent").try_cast(validate.working_type(C.SOURCE_SCHEMAS[spec.name]["discount_percent"])),
    }
    rows = parsed.withColumns(working).withColumn("unit_cost", F.col("unit_price"))
    return with_line_amounts(rows).select(*key, "gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount")


def _dirty_rates(s: Sample) -> DataFrame:
    return validate.typed(SPECS["exchange_rates"], s.dirty["exchange_rates"])


@query
def fx_dedup(s: Sample) -> DataFrame:
    return fx.daily_rates(_dirty_rates(s))


@query
def fx_latest(s: Sample) -> DataFrame:
    return fx.latest_rates(fx.daily_rates(s.clean["exchange_rates"]))


def _orders_with_rate(s: Sample, fallback: str) -> DataFrame:
    orders = s.clean["orders"].select("order_id", "currency", "order_date")
    return fx.attach_rates(orders, s.clean["exchange_rates"], fallback=fallback).select(
        "order_id", "currency", "order_date", "fx_rate"
    )


@query
def fx_attach_latest(s: Sample) -> DataFrame:
    return _orders_with_rate(s, "latest")


@query
def fx_attach_asof(s: Sample) -> DataFrame:
    return _orders_with_rate(s, "asof")


def _payment_by_order(s: Sample) -> DataFrame:
    return payment_by_order(s.clean["payments"])


_register("payment_by_order", _payment_by_order)


@query
def order_total_rollup(s: Sample) -> DataFrame:
    return order_totals(s.clean["orders"].select("order_id"), s.clean["order_items"])


# --- dimensions ------------------------------------------------------------


@query
def dim_date_seed(s: Sample) -> DataFrame:
    """Seeded calendar with the number of runs started on each day."""
    runs = s.tables.table("events").groupBy(F.to_date("ts").alias("full_date")).agg(
        F.count("*").alias("runs_started")
    )
    calendar = dims.calendar_seed(s.spark).join(runs, "full_date", "left")
    return calendar.withColumn("runs_started", F.coalesce("runs_started", F.lit(0).cast("bigint")))


@query
def dim_date_from_data(s: Sample) -> DataFrame:
    return dims.dates_in_data(s.tables.dated_tables())


@query
def dim_date(s: Sample) -> DataFrame:
    return dims.dim_date(s.spark, s.tables.dated_tables())


def _dimension(table: str) -> Callable[[Sample], DataFrame]:
    """Keep-first dimension of the dirty rows, where ids do repeat."""
    return lambda s: dims.dimension(table, validate.typed(SPECS[table], s.dirty[table]))


_register("dim_customer", _dimension("customers"))
_register("dim_store", _dimension("stores"))
_register("dim_product", _dimension("products"))


def _with_usage(dim: DataFrame, code: str, rows: DataFrame, used: str, name: str) -> DataFrame:
    """A seeded dimension with the number of source rows that carry each code."""
    usage = rows.groupBy(F.col(used).alias(code)).agg(F.count("*").alias(name))
    return dim.join(usage, code, "left").withColumn(
        name, F.coalesce(name, F.lit(0).cast("bigint"))
    )


@query
def dim_channel(s: Sample) -> DataFrame:
    return _with_usage(
        dims.dim_channel(s.spark), "channel_code", s.clean["orders"], "sales_channel", "orders"
    )


@query
def dim_currency_seed(s: Sample) -> DataFrame:
    return _with_usage(
        dims.dim_currency(s.spark), "currency_code", s.clean["orders"], "currency", "orders"
    )


@query
def dim_payment_method(s: Sample) -> DataFrame:
    return _with_usage(
        dims.dim_payment_method(s.spark),
        "payment_method_code",
        s.clean["payments"],
        "payment_method",
        "payments",
    )


@query
def dim_currency_refresh(s: Sample) -> DataFrame:
    return dims.refresh_currency_rates(dims.dim_currency(s.spark), s.clean["exchange_rates"])


@query
def dim_keys(s: Sample) -> DataFrame:
    parts = [
        s.keyed[name].select(
            F.lit(name).alias("dimension"),
            F.col(surrogate).alias("surrogate_key"),
            F.col(business).alias("business_key"),
        )
        for name, (_, business, surrogate) in dims.DIM_KEYS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- facts and merges ------------------------------------------------------


@query
def fact_sales(s: Sample) -> DataFrame:
    return facts.fact_sales(s.clean, s.keyed)


@query
def fact_delivery(s: Sample) -> DataFrame:
    return facts.fact_delivery(s.clean, s.keyed)


@query
def merge_dim_customer(s: Sample) -> DataFrame:
    """Two loads: sign-ups before October, then sign-ups from April with new segments."""
    customers = dims.dimension("customers", s.clean["customers"], unique=True)
    day = F.col("signup_date")
    first = customers.filter(day < "1994-10-01").withColumn("customer_segment", F.lit("NEW"))
    second = customers.filter(day >= "1994-04-01").withColumn("city", F.upper("city"))
    target = dense_keys(first, "customer_id", "customer_key")
    return upsert(target, second, "customer_id", "customer_key")


def _merge_fact(fact: DataFrame, key: str, surrogate: str, changed: str) -> DataFrame:
    """Two loads of a monthly table, overlapping in 1998-1999; the first one held another status."""
    spark = fact.sparkSession
    table = MonthlyTable(spark, f"{work_dir(spark)}/fact", key, surrogate)
    with scratch(spark) as write:
        fact = write(with_row_ids(fact), "fact")
        table.merge(fact.filter(F.col("date_key") < 20000101).withColumn(changed, F.lit("EARLIER")), stored=True)
        table.merge(fact.filter(F.col("date_key") >= 19980101), stored=True)
    return table.read().drop("month")


@query
def merge_fact_sales(s: Sample) -> DataFrame:
    """All load columns of the sales fact, merged by order line."""
    return _merge_fact(facts.fact_sales(s.clean, s.keyed), "source_order_item_id", "sales_key", "order_status")


@query
def merge_fact_delivery(s: Sample) -> DataFrame:
    """All load columns of the delivery fact, merged by delivery."""
    return _merge_fact(facts.fact_delivery(s.clean, s.keyed), "delivery_id", "delivery_key", "delivery_status")


# --- marts -----------------------------------------------------------------


def _mart(name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: s.mart(name)


for _name in (*marts.SALES_MARTS, "delivery_performance"):
    _short = _name if _name == "monthly_sales" else _name.removesuffix("_performance")
    _register(f"mart_{_short}", _mart(_name))


# --- the whole flow: dirty sources, validation, keyed star, marts --------------


for _name in ("fact_sales", "fact_delivery"):
    _register(f"e2e_{_name}", lambda s, fact=_name: s.loaded.fact(fact))

for _name in (*marts.SALES_MARTS, "delivery_performance"):
    _short = _name if _name == "monthly_sales" else _name.removesuffix("_performance")
    _register(f"e2e_mart_{_short}", lambda s, mart=_name: s.loaded.mart(mart))


# --- measures --------------------------------------------------------------


@query
def measures_exec(s: Sample) -> DataFrame:
    return measures.summarise(s.mart("monthly_sales"), measures.executive())


@query
def measures_customer(s: Sample) -> DataFrame:
    return measures.summarise(s.mart("customer_performance"), measures.customer())


@query
def measures_store(s: Sample) -> DataFrame:
    return measures.summarise(s.mart("store_performance"), measures.store())


@query
def measures_delivery(s: Sample) -> DataFrame:
    return measures.summarise(s.mart("delivery_performance"), measures.delivery())


@query
def measures_ops(s: Sample) -> DataFrame:
    stores = measures.summarise(s.mart("store_performance"), measures.store())
    names = list(measures.delivery())
    deliveries = measures.summarise(s.mart("delivery_performance"), measures.delivery())
    packed = stores.withColumn("_d", deliveries.select(F.struct(*names)).scalar())
    return packed.withColumns({n: F.col(f"_d.{n}") for n in names}).drop("_d")


@query
def measures_bundle(s: Sample) -> DataFrame:
    return measures.bundle(s.marts(*measures.BUNDLED), s.mart("delivery_performance"))


@query
def m_run_counts(s: Sample) -> DataFrame:
    return measures.run_counts_by_status(s.runs)


@query
def m_run_records(s: Sample) -> DataFrame:
    return measures.summarise(s.runs, measures.run_records())


@query
def m_avg_duration(s: Sample) -> DataFrame:
    return measures.average_duration(s.runs)


@query
def m_latest_quality(s: Sample) -> DataFrame:
    return measures.latest_quality(s.runs)


@query
def m_dq(s: Sample) -> DataFrame:
    return measures.summarise(s.dq_history, measures.data_quality())


def _share(mart: str, by: str) -> Callable[[Sample], DataFrame]:
    return lambda s: measures.share_of_all(s.mart(mart), [by], "sales", "revenue_share")


_register("category_share", _share("category_performance", "category"))
_register("channel_share", _share("channel_performance", "channel_name"))
_register("product_share", _share("product_performance", "product_id"))


@query
def margins(s: Sample) -> DataFrame:
    """Profit margin by category, channel and product."""
    members = {"category_performance": "category", "channel_performance": "channel_name", "product_performance": "product_id"}
    return measures.margins(s.marts(*members), members)


@query
def segment_share(s: Sample) -> DataFrame:
    return measures.share_within(
        s.mart("customer_performance"),
        ["country", "customer_segment"],
        "customer_segment",
        "sales",
        "segment_share",
    )


@query
def delivery_status_share(s: Sample) -> DataFrame:
    return measures.share_within(
        s.mart("delivery_performance"),
        ["delivery_type", "delivery_status"],
        "delivery_status",
        "deliveries",
        "status_share",
        "bigint",
    )


# --- reports ---------------------------------------------------------------


@query
def monthly_sales_yearmonth(s: Sample) -> DataFrame:
    return marts.with_year_month(s.mart("monthly_sales"))


@query
def rpt_revenue_trend(s: Sample) -> DataFrame:
    return reports.revenue_trend(s.mart("monthly_sales"))


@query
def rpt_revenue_by_year(s: Sample) -> DataFrame:
    return reports.revenue_by_year(s.mart("monthly_sales"))


@query
def rpt_year_filtered(s: Sample) -> DataFrame:
    """A year slicer cuts the monthly mart and leaves the category mart alone."""
    year = reports.revenue_by_year(s.mart("monthly_sales"), F.col("year") == 1998)
    category = measures.summarise(
        s.mart("category_performance"), {"total_revenue": measures.money_total("sales")}, ["category"]
    )
    return year.select(
        F.lit("monthly_sales").alias("mart"), F.col("year").cast("string").alias("member"), "total_revenue"
    ).unionByName(
        category.select(
            F.lit("category_performance").alias("mart"),
            F.col("category").alias("member"),
            "total_revenue",
        )
    )


def _page(mart: str, column: str, *values: str) -> Callable[[Sample], DataFrame]:
    """What is shown on all marts when a slicer on one of them is set."""

    def build(s: Sample) -> DataFrame:
        names = ("category_performance", "channel_performance", "customer_performance", "store_performance")
        sales = cut_lineage(s.marts(*names), "marts")
        frames = {n: marts.one_of(sales, n) for n in names}
        frames["delivery_performance"] = s.mart("delivery_performance")
        shown = (
            ("category_performance", "category", "sales"),
            ("channel_performance", "channel_name", "sales"),
            ("customer_performance", "customer_segment", "sales"),
            ("customer_performance", "country", "sales"),
            ("store_performance", "store_type", "sales"),
            ("delivery_performance", "delivery_status", "total_delivery_fee"),
        )
        return filters.page(filters.Filters().select(mart, column, *values), [(m, frames[m], by, f) for m, by, f in shown])

    return build


#: Slicers that are set, one at a time.
#: Countries that are chosen beside.
SLICED_COUNTRIES = ("NATION_5", "NATION_9", "NATION_15")
SLICED = {
    "category": ("category_performance", "category", "ECONOMY", "STANDARD"),
    "channel": ("channel_performance", "channel_name", "Website"),
    "segment": ("customer_performance", "customer_segment", "VIP", "NEW"),
    "store_type": ("store_performance", "store_type", "DARK_STORE"),
    "delivery_status": ("delivery_performance", "delivery_status", "DELIVERED"),
}
for _name, _choice in SLICED.items():
    _register(f"rpt_sliced_{_name}", _page(*_choice))


@query
def share_sliced_segment(s: Sample) -> DataFrame:
    """Two countries and two segments chosen: each segment's share of the countries, whatever segments are chosen."""
    chosen = filters.Filters().select("customer_performance", "customer_segment", "VIP", "NEW")
    customers = s.mart("customer_performance")
    chosen = chosen.select("customer_performance", "country", *SLICED_COUNTRIES)
    return filters.share(chosen, "customer_performance", customers, "customer_segment", "sales", "segment_share", ["customer_segment"])


@query
def rpt_category(s: Sample) -> DataFrame:
    return reports.sales_with_share(s.mart("category_performance"), "category")


@query
def rpt_channel(s: Sample) -> DataFrame:
    return reports.sales_with_share(s.mart("channel_performance"), "channel_name")


@query
def rpt_channel_profit(s: Sample) -> DataFrame:
    return reports.sales_and_profit(s.mart("channel_performance"), "channel_name")


@query
def rpt_category_profit(s: Sample) -> DataFrame:
    return reports.sales_and_profit(s.mart("category_performance"), "category")


@query
def top_products(s: Sample) -> DataFrame:
    return reports.top_products(s.mart("product_performance"))


@query
def rpt_segment(s: Sample) -> DataFrame:
    return reports.segments(s.mart("customer_performance"))


@query
def rpt_customer_country(s: Sample) -> DataFrame:
    groups = measures.summarise(
        s.mart("customer_performance"),
        {"customer_revenue": measures.money_total("sales")},
        ["country"],
    )
    return reports.ranked(groups, "customer_revenue", "country")


@query
def top_customers(s: Sample) -> DataFrame:
    return reports.top_customers(s.mart("customer_performance"))


@query
def rpt_store_type(s: Sample) -> DataFrame:
    return reports.store_types(s.mart("store_performance"))


@query
def top_stores(s: Sample) -> DataFrame:
    return reports.top_stores(s.mart("store_performance"))


@query
def rpt_delivery_status(s: Sample) -> DataFrame:
    return reports.delivery_status(s.mart("delivery_performance"))


@query
def rpt_delivery_type(s: Sample) -> DataFrame:
    return reports.delivery_types(s.mart("delivery_performance"))


@query
def rpt_delivery_matrix(s: Sample) -> DataFrame:
    return reports.delivery_matrix(s.mart("delivery_performance"))


@query
def rpt_runs_by_status(s: Sample) -> DataFrame:
    return reports.runs_by_status(s.runs)


@query
def rpt_dq_by_table(s: Sample) -> DataFrame:
    return reports.dq_by_table(s.dq_history)


@query
def rpt_dq_by_rule(s: Sample) -> DataFrame:
    return reports.dq_by_rule(s.dq_history)


@query
def rpt_dq_by_run_status(s: Sample) -> DataFrame:
    return reports.dq_of_runs(s.dq_history, s.runs, F.col("status") == "FAILED")


@query
def rpt_run_log(s: Sample) -> DataFrame:
    return reports.run_log(s.runs)


@query
def slicer_values(s: Sample) -> DataFrame:
    names = ("monthly_sales", "category_performance", "channel_performance", "customer_performance", "store_performance")
    sales = {
        "year": ("monthly_sales", "year"),
        "category": ("category_performance", "category"),
        "channel": ("channel_performance", "channel_name"),
        "customer_segment": ("customer_performance", "customer_segment"),
        "customer_country": ("customer_performance", "country"),
        "store_type": ("store_performance", "store_type"),
        "store_country": ("store_performance", "country"),
    }
    plain = lambda *columns: {slicer: (c, None) for slicer, c in columns}
    deliveries = plain(("delivery_status", "delivery_status"), ("delivery_type", "delivery_type"), ("channel_group", "channel_group"))
    return reports.slicer_values(
        [
            (s.marts(*names), {slicer: (f"{m}.{c}", F.col("mart") == m) for slicer, (m, c) in sales.items()}),
            (s.mart("delivery_performance"), deliveries),
            (s.runs, plain(("run_status", "status"))),
            (s.dq_history, plain(("dq_table", "table_name"))),
        ]
    )


@query
def date_hierarchy(s: Sample) -> DataFrame:
    """Hierarchy columns of every day on which quality results were written."""
    days = s.dq_history.select(F.to_date("created_at").alias("date")).distinct()
    return days.select("date", *hierarchy_columns(F.col("date")))


@query
def runs_by_date_hierarchy(s: Sample) -> DataFrame:
    return reports.by_date_hierarchy(s.runs, "started_at", "pipeline_runs")


# --- constraint checks -----------------------------------------------------


@query
def chk_unique(s: Sample) -> DataFrame:
    keyed = s.keyed
    return checks.unique_violations(
        [
            ("dim_customer", keyed["dim_customer"], "customer_key"),
            ("dim_product", keyed["dim_product"], "product_key"),
            ("dim_store", keyed["dim_store"], "store_key"),
            ("fact_sales", s.lines, "source_order_item_id"),
            ("fact_delivery", facts.delivery_events(s.clean, s.star), "delivery_id"),
            ("source_order_items", s.dirty["order_items"], "order_item_id"),
        ]
    )


@query
def chk_fk(s: Sample) -> DataFrame:
    lines, deliveries = s.lines, facts.delivery_events(s.clean, s.star)
    return checks.foreign_key_violations(
        [
            ("fact_sales_customer", lines, s.star["dim_customer"], "customer_key"),
            ("fact_sales_product", lines, s.star["dim_product"], "product_key"),
            ("fact_sales_store", lines, s.star["dim_store"], "store_key"),
            ("fact_sales_channel", lines, s.star["dim_channel"], "channel_key"),
            ("fact_sales_date", lines, s.star["dim_date"], "date_key"),
            ("fact_delivery_store", deliveries, s.star["dim_store"], "store_key"),
            (
                "source_orders_customer",
                s.dirty["orders"],
                validate.valid_rows(s.tagged("customers")),
                "customer_id",
            ),
        ]
    )


@query
def chk_fact_sales(s: Sample) -> DataFrame:
    """Value checks of both facts."""
    sales = checks.condition_violations(s.lines, checks.fact_sales_conditions())
    events = facts.delivery_events(s.clean, s.star)
    return sales.unionByName(
        checks.condition_violations(events, checks.fact_delivery_conditions())
    )


@query
def chk_dims(s: Sample) -> DataFrame:
    """Checks on dimensions of unvalidated rows, so that violations exist."""
    frames = {
        "dim_product": validate.typed(SPECS["products"], s.dirty["products"]),
        "dim_store": validate.typed(SPECS["stores"], s.dirty["stores"]),
        "dim_currency": validate.typed(SPECS["exchange_rates"], s.dirty["exchange_rates"]),
        "dim_date": s.star["dim_date"],
    }
    out = None
    for name, conditions in checks.dimension_conditions().items():
        part = checks.condition_violations(frames[name], conditions).select(
            F.lit(name).alias("table_name"), "check_name", "violations"
        )
        out = part if out is None else out.unionByName(part)
    return out


def _damaged(s: Sample) -> DataFrame:
    """Order lines with defects at positions fixed by the order's number, as a faulty load would leave them."""
    number = F.substring("source_order_id", 5, 20).cast("bigint") % 17
    lines = s.lines.withColumns(
        {
            "quantity": F.when(number == 3, -F.col("quantity")).otherwise(F.col("quantity")),
            "net_amount_inr": F.when(number == 5, -F.col("net_amount_inr")).otherwise(F.col("net_amount_inr")),
            "customer_key": F.when(number == 7, F.concat("customer_key", F.lit("-gone"))).otherwise(F.col("customer_key")),
            "date_key": F.when(number == 9, F.lit(19000101)).otherwise(F.col("date_key")),
        }
    )
    twice = F.when(number == 11, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("_copy", F.explode(twice)).drop("_copy")


@query
def chk_damaged_facts(s: Sample) -> DataFrame:
    """All checks of the sales fact over damaged lines, which violate some of them."""
    lines = cut_lineage(_damaged(s).select("source_order_item_id", "customer_key", "date_key", "quantity", *[c for c in _FACT_AMOUNTS]), "damaged")
    unique = checks.unique_violations([("fact_sales", lines, "source_order_item_id")])
    links = checks.foreign_key_violations(
        [
            ("fact_sales_customer", lines, s.star["dim_customer"], "customer_key"),
            ("fact_sales_date", lines, s.star["dim_date"], "date_key"),
        ]
    )
    values = checks.condition_violations(lines, checks.fact_sales_conditions())
    return unique.unionByName(links).unionByName(values)


_FACT_AMOUNTS = ("unit_price", *_AMOUNTS[:-1], *[f"{a}_inr" for a in _AMOUNTS[:-1]])


@query
def chk_damaged_monitoring(s: Sample) -> DataFrame:
    """The ledger's checks over runs of which some have another status, negative counts or an impossible score."""
    number = F.col("run_id") % 7
    runs = s.runs.withColumns(
        {
            "status": F.when(number == 1, F.lit("DONE")).otherwise(F.col("status")),
            "records_loaded": F.when(number == 2, F.lit(-1).cast("bigint")).otherwise(F.col("records_loaded")),
            "quality_score": F.when(number == 3, F.lit(100.5)).otherwise(F.col("quality_score")).cast("decimal(5,2)"),
        }
    )
    return checks.condition_violations(runs, checks.run_conditions())


@query
def chk_monitoring(s: Sample) -> DataFrame:
    runs = checks.condition_violations(s.runs, checks.run_conditions())
    results = checks.condition_violations(s.dq_history, checks.dq_conditions())
    return runs.unionByName(results)
