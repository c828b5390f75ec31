"""Amounts, rates, payments, keys, merges, facts, checks and skew."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.fixtures import row, sources, text_frame
from tradeloom import contracts as C
from tradeloom.operators import amounts, checks, dims, facts, fx, joins, keys, merge, payments, validate
from tradeloom.operators.rules import SPECS
from tradeloom.plans import filters, measures, reports


def typed(spark, **rows):
    return {n: validate.typed(SPECS[n], df) for n, df in sources(spark, **rows).items()}


def star(valid):
    return {n: dims.keyed_dimension(n, valid) for n in dims.DIM_KEYS}


LINE = "quantity int, unit_price decimal(18,6), discount_percent decimal(18,6), unit_cost decimal(12,2)"


def test_line_amounts(spark):
    rows = [(2, Decimal(100), Decimal(10), Decimal(40)), (1, Decimal(50), Decimal(0), Decimal(20)),
            (1, Decimal("10"), None, None), (3, Decimal("1.115"), Decimal("50"), Decimal("1"))]
    out = amounts.with_line_amounts(spark.createDataFrame(rows, LINE)).collect()
    figures = [tuple(float(r[c]) for c in amounts.LINE_AMOUNTS) for r in out]
    assert figures == [(200, 20, 180, 80, 100), (50, 0, 50, 20, 30), (10, 0, 10, 0, 10),
                       (3.34, 1.67, 1.67, 3, -1.33)]
    # Gross is taken before the stored price is rounded (half to even: 1.115 -> 1.12).
    assert out[3]["unit_price"] == Decimal("1.12")


def test_inr_amounts_follow_the_given_rate(spark):
    lines = spark.createDataFrame([(1, Decimal(10), Decimal(0), Decimal(4))], LINE)
    priced = amounts.with_line_amounts(lines).withColumn("fx_rate", F.lit("83.5").cast(C.RATE))
    out = amounts.with_inr_amounts(priced).first()
    assert (out["net_amount_inr"], out["unit_price_inr"], out["cost_amount_inr"]) == (835, 835, 334)
    missing = amounts.with_inr_amounts(priced.withColumn("fx_rate", F.lit(None).cast(C.RATE))).first()
    assert missing["net_amount_inr"] is None


RATES = "_raw_id bigint, currency_code string, rate_date date, rate_to_inr decimal(18,6)"


def test_rate_fallbacks(spark):
    orders = spark.createDataFrame(
        [(1, "USD", date(2024, 1, 1)), (2, "USD", date(2024, 6, 1)), (3, "USD", date(2023, 1, 1)),
         (4, "USD", date(2025, 6, 1)), (5, "INR", date(2024, 1, 1)), (6, "EUR", date(2024, 1, 1))],
        "id int, currency string, order_date date")
    rates = spark.createDataFrame(
        [(1, "USD", date(2024, 1, 1), Decimal(79)), (2, "USD", date(2024, 12, 31), Decimal(84)),
         (3, "USD", date(2024, 1, 1), Decimal(80))], RATES)

    def attached(fallback):
        out = fx.attach_rates(orders, rates, fallback=fallback).orderBy("id").collect()
        return [None if r["fx_rate"] is None else float(r["fx_rate"]) for r in out]

    assert attached("latest") == [80, 84, 84, 84, 1, None]
    assert attached("asof") == [80, 80, None, 84, 1, None]


def test_payment_choice(spark):
    rows = [(1, "A", "UPI", "FAILED"), (2, "A", "CASH", "SUCCESS"), (3, "A", "PAYPAL", "SUCCESS"),
            (4, "B", "WALLET", "PENDING"), (5, "B", "UPI", "FAILED")]
    df = spark.createDataFrame(rows, "_raw_id bigint, order_id string, payment_method string, payment_status string")
    out = {r["order_id"]: r["payment_method"] for r in payments.payment_by_order(df).collect()}
    assert out == {"A": "CASH", "B": "WALLET"}


def test_fact_sales_contract(spark):
    valid = typed(spark)
    fact = checks.require_types(facts.fact_sales(valid, star(valid)), C.FACT_SALES_SCHEMA)
    assert fact.columns == list(C.FACT_SALES_SCHEMA)
    first, second = fact.collect(), fact.collect()
    assert first == second and len(first) == 1
    assert first[0]["net_amount"] == Decimal("202.50")
    delivery = facts.fact_delivery(valid, star(valid))
    checks.require_types(delivery, C.FACT_DELIVERY_SCHEMA)
    assert [r["delivery_id"] for r in delivery.collect()] == ["DEL-1"]
    empty = {**valid, "deliveries": valid["deliveries"].filter("false")}
    assert facts.fact_delivery(empty, star(valid)).columns == list(C.FACT_DELIVERY_SCHEMA)
    assert facts.fact_delivery(empty, star(valid)).count() == 0


def test_lines_without_partners_vanish(spark):
    valid = typed(
        spark,
        order_items=[row("order_items"), row("order_items", order_item_id="I-2", product_id="none"),
                     row("order_items", order_item_id="I-3", order_id="none")],
    )
    valid["payments"] = valid["payments"].filter("false")
    rows = facts.fact_sales(valid, star(valid)).collect()
    assert [(r["source_order_item_id"], r["payment_method_key"]) for r in rows] == [("ITEM-1", None)]


def test_dense_keys(spark):
    df = spark.range(5000).select(F.concat(F.lit("K-"), F.col("id")).alias("k"), F.col("id").alias("v"))
    numbered = keys.dense_keys(df, "k", "sk")
    rows = {r["k"]: r["sk"] for r in numbered.collect()}
    assert sorted(rows.values()) == list(range(1, 5001))
    again = {r["k"]: r["sk"] for r in keys.dense_keys(df.repartition(7), "k", "sk").collect()}
    assert again == rows


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2)], "sk bigint, k string, v string, w int")
    source = spark.createDataFrame([("b", None, 9), ("c", "z", 3)], "k string, v string, w int")
    out = merge.upsert(target, source, "k", "sk")
    assert sorted(map(tuple, out.collect())) == [(1, "a", "x", 1), (2, "b", None, 9), (3, "c", "z", 3)]
    again = merge.upsert(out, source, "k", "sk")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    partial = merge.upsert(target, source, "k", "sk", update=["w"])
    assert {r["k"]: r["v"] for r in partial.collect()} == {"a": "x", "b": "y", "c": "z"}


def test_update_only_and_seed(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    assert sorted(map(tuple, merge.update_only(target, source, "k", "v").collect())) == [("a", 1), ("b", 5)]
    seeded = merge.insert_if_absent(target, source, "k").collect()
    assert sorted(map(tuple, seeded)) == [("a", 1), ("b", 2), ("c", 6)]


def test_seeds_and_calendar(spark):
    days = dims.calendar_seed(spark)
    assert days.count() == 5844
    assert (dims.dim_channel(spark).count(), dims.dim_payment_method(spark).count()) == (4, 7)
    currencies = dims.dim_currency(spark)
    assert dict(currencies.dtypes)["rate_to_inr"] == C.RATE and currencies.count() == 12


def test_first_per_key_keeps_the_earliest(spark):
    df = spark.createDataFrame([(3, "a", "late"), (1, "a", "early"), (2, "b", None)],
                               "_raw_id bigint, k string, v string")
    assert sorted(map(tuple, dims.first_per_key(df, "k").collect())) == [("a", "early"), ("b", None)]


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1)], "k string, v int")
    assert [r["k"] for r in reports.top_n(df, "v", 2, ["k"]).collect()] == ["a", "b", "c", "d"]
    assert reports.top_n(df, "v", 9, ["k"]).count() == 5


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    with pytest.raises(TypeError, match="missing"):
        checks.require_types(df, {"amount": "decimal(14,2)"})
    with pytest.raises(TypeError, match="expected decimal"):
        checks.require_types(df, {"n": "decimal(14,2)"})
    wider = checks.add_missing_columns(df, {"n": "int", "score": "decimal(5,2)"})
    assert dict(wider.dtypes)["score"] == "decimal(5,2)" and wider.first()["score"] is None


def test_broadcast_is_size_checked(spark, tmp_path, monkeypatch):
    small = str(tmp_path / "small")
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(small)
    right = spark.read.parquet(small)
    left = spark.range(10).withColumnRenamed("id", "k")
    assert 0 < joins.input_bytes(right) < joins.BROADCAST_INPUT_LIMIT

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(joins.lookup_join(left, right, "k"))
    monkeypatch.setattr(joins, "BROADCAST_INPUT_LIMIT", 10)
    assert "broadcast" not in plan(joins.lookup_join(left, right, "k"))


def test_hot_key_is_split_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    """A third of all rows share one key; the shuffle join splits it."""
    monkeypatch.setattr(joins, "BROADCAST_INPUT_LIMIT", -1)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings if spark.conf.get(k, None) is not None}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        left = spark.range(0, n, 1, 16).select(
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K-"), F.col("id"))).alias("k"),
            F.md5(F.col("id").cast("string")).alias("payload"))
        path = str(tmp_path / "dim")
        left.select("k").distinct().withColumn("attr", F.lit(1)).write.parquet(path)
        joined = joins.lookup_join(left, spark.read.parquet(path), "k", "left")
        counts = joined.groupBy("k").agg(F.count("*").alias("n"), F.sum("attr").alias("s"))
        total = counts.agg(F.sum("n"), F.sum("s"), F.max("n"))
        assert tuple(total.first()) == (n, n, n // 3)
        probe = joined.agg(F.sum(F.crc32("payload")), F.sum("attr"))
        probe.collect()
        assert "skew=true" in probe._jdf.queryExecution().executedPlan().toString()
        # An aggregate on the join key must not keep the hot partition whole either.
        grouped = joined.groupBy("k", "attr").agg(F.sum(F.crc32("payload")).alias("c"))
        assert grouped.agg(F.sum("c")).first()[0] == probe.first()[0]
        grouped.collect()
        assert "skew=true" in grouped._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_product_shares_are_of_all_products_without_one_task(spark):
    rows = [(f"p{i % 40}", Decimal(i), Decimal(1)) for i in range(200)]
    products = spark.createDataFrame(rows, "product_name string, sales decimal(18,2), profit decimal(18,2)")
    top = reports.top_products(products, 3)
    assert "Window" not in top._jdf.queryExecution().executedPlan().toString()
    found = [(r["product_name"], float(r["sales"]), float(r["revenue_share"])) for r in top.collect()]
    expected = sorted(((f"p{k}", sum(float(i) for i in range(k, 200, 40))) for k in range(40)), key=lambda x: -x[1])[:3]
    assert [(name, sales) for name, sales, _ in found] == expected
    assert [share for _, _, share in found] == pytest.approx([sales / 19900 for _, sales in expected], abs=1e-3)


def test_asof_rates_need_no_row_per_day(spark):
    """Two quotes a thousand years apart, and a gap of years without any."""
    rates = spark.createDataFrame(
        [(0, "USD", date(1020, 1, 1), Decimal(80)), (1, "USD", date(2024, 6, 1), Decimal(84)), (2, "EUR", date(2024, 1, 5), Decimal(90))],
        "_raw_id bigint, currency_code string, rate_date date, rate_to_inr decimal(18,6)",
    )
    days = [date(1019, 12, 31), date(1020, 1, 1), date(1500, 3, 4), date(2024, 5, 31), date(2024, 6, 1), date(2024, 6, 2), date(2300, 1, 1)]
    orders = spark.createDataFrame([("USD", d) for d in days] + [("EUR", date(2023, 1, 1)), ("EUR", None), (None, days[0])],
                                   "currency string, order_date date")
    daily = fx.daily_rates(rates)
    found = fx.asof_rates(orders, daily, "currency", "order_date")
    assert found.count() == len(days) + 1  # no more rows than asked for
    rows = {(r["currency"], r["order_date"]): r["fx_rate"] for r in fx.attach_rates(orders, rates, fallback="asof").collect()}
    assert [rows["USD", d] and int(rows["USD", d]) for d in days] == [None, 80, 80, 80, 84, 84, 84]
    assert rows["EUR", date(2023, 1, 1)] is None and rows[None, days[0]] is None and len(rows) == 10


def test_filters(spark):
    mart = spark.createDataFrame(
        [("IN", "VIP", Decimal(10)), ("IN", "NEW", Decimal(30)), ("FR", "VIP", Decimal(5)), ("FR", None, Decimal(15))],
        "country string, segment string, sales decimal(18,2)",
    )
    chosen = filters.Filters().select("m", "segment", "VIP", "NEW").select("m", "country", "IN")
    kept = filters.filtered(chosen, "m", mart, {"sales": measures.money_total("sales")}, ["segment"])
    assert {r["segment"]: int(r["sales"]) for r in kept.collect()} == {"VIP": 10, "NEW": 30}
    assert chosen.rows("another", mart).count() == 4
    one = chosen.select("m", "segment", "VIP")  # replaces the earlier choice
    share = lambda f, *freed: {r["segment"]: r["s"] for r in filters.share(f, "m", mart, "segment", "sales", "s", freed).collect()}
    assert share(one, "segment") == {"VIP": 0.25}
    assert share(one) == {"VIP": pytest.approx(10 / 60)}  # of the whole mart
    assert one.free("m", "country").rows("m", mart).count() == 2
    assert filters.Filters().select("m", "segment", None).rows("m", mart).count() == 1
    assert filters.Filters().select("m", "segment").rows("m", mart).count() == 0
    top = reports.top_n(chosen.rows("m", mart), "sales", 1, ["segment"])
    assert [r["segment"] for r in top.collect()] == ["NEW"]


def test_prices_keep_their_digits(spark):
    raw = text_frame(spark, "order_items", [row("order_items", quantity="3", unit_price="1.23456789", discount_percent="12.3456")])
    lines = validate.typed(SPECS["order_items"], raw).withColumn("unit_cost", F.lit(None).cast("decimal(12,2)"))
    assert lines.first()["unit_price"] == Decimal("1.23456789")
    big = validate.typed(SPECS["order_items"], text_frame(spark, "order_items", [row("order_items", quantity="2147483647", unit_price="4999999999.12345678")]))
    out = amounts.with_line_amounts(lines).first()
    assert (out["gross_amount"], out["discount_amount"]) == (Decimal("3.70"), Decimal("0.46"))
    exact = big.select((F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")).alias("p")).first()["p"]
    assert exact == Decimal(2147483647) * Decimal("4999999999.12345678")
