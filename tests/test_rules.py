"""Every rule with a bad row next to a good one, precedence, counts and cascades."""

import re
import threading

import pytest
from pyspark.sql import functions as F

from tests.fixtures import row, sources, text_frame
from tradeloom import contracts as C
from tradeloom.contracts import OVERALL_RULE, RULE_REASONS
from tradeloom.operators import joins, landing, rejects, validate
from tradeloom.operators.rules import SPECS

# Table -> rule -> cells that break exactly that rule.
BAD_CELLS = {
    "customers": {
        "required_customer_id": {"customer_id": " \t "},
        "duplicate_customer_id": {"customer_id": " CUST-7"},
        "required_email": {"email": "  "},
        "invalid_email_format": {"email": "mira.example.org"},
        "invalid_signup_date": {"signup_date": "2022-02-30"},
        "invalid_customer_segment": {"customer_segment": "GOLD"},
    },
    "products": {
        "required_product_id": {"product_id": ""},
        "duplicate_product_id": {"product_id": "PRD-3 "},
        "required_product_name": {"product_name": "\n"},
        "required_category": {"category": ""},
        "invalid_unit_cost": {"unit_cost": "1,000"},
        "invalid_selling_price": {"selling_price": "nan"},
        "negative_unit_cost": {"unit_cost": "-0.01"},
        "negative_selling_price": {"selling_price": "-1", "unit_cost": "0"},
        "unit_cost_exceeds_selling_price": {"unit_cost": "75.01"},
        "invalid_product_rating": {"product_rating": "5.01"},
    },
    "stores": {
        "required_store_id": {"store_id": ""},
        "duplicate_store_id": {"store_id": "STR-9"},
        "invalid_store_type": {"store_type": "WAREHOUSE"},
        "invalid_latitude": {"latitude": "90.000001"},
        "invalid_longitude": {"longitude": "-180.5"},
        "invalid_opening_date": {"opening_date": "not-a-date"},
    },
    "orders": {
        "required_order_id": {"order_id": ""},
        "duplicate_order_id": {"order_id": "ORD-5"},
        "invalid_order_date": {"order_date": "2024-13-45"},
        "invalid_sales_channel": {"sales_channel": "FAX"},
        "invalid_order_status": {"order_status": "SHIPED"},
        "invalid_currency": {"currency": "EURO"},
        "invalid_order_total": {"order_total": "-0.5"},
        "orphan_customer_id": {"customer_id": "CUST-0"},
        "orphan_store_id": {"store_id": ""},
    },
    "order_items": {
        "required_order_item_id": {"order_item_id": ""},
        "duplicate_order_item_id": {"order_item_id": "ITEM-1"},
        "invalid_quantity": {"quantity": "2.5"},
        "invalid_unit_price": {"unit_price": "-9.99"},
        "invalid_discount_percent": {"discount_percent": "100.5"},
        "orphan_order_id": {"order_id": "ORD-0"},
        "orphan_product_id": {"product_id": "PRD-0"},
    },
    "payments": {
        "required_payment_id": {"payment_id": ""},
        "duplicate_payment_id": {"payment_id": "PAY-1"},
        "invalid_payment_method": {"payment_method": "CHEQUE"},
        "invalid_payment_status": {"payment_status": "OK"},
        "invalid_payment_amount": {"payment_amount": ""},
        "invalid_payment_date": {"payment_date": "soon"},
        "invalid_currency": {"currency": "US"},
        "orphan_order_id": {"order_id": "ORD-0"},
    },
    "deliveries": {
        "required_delivery_id": {"delivery_id": ""},
        "duplicate_delivery_id": {"delivery_id": "DEL-1"},
        "invalid_delivery_type": {"delivery_type": "DRONE"},
        "invalid_delivery_status": {"delivery_status": "LOST"},
        "invalid_delivery_distance": {"delivery_distance_km": "-0.1"},
        "invalid_delivery_time": {"delivery_time_minutes": "200001"},
        "invalid_delivery_fee": {"delivery_fee": "free"},
        "orphan_order_id": {"order_id": "ORD-0"},
        "orphan_store_id": {"store_id": "STR-0"},
    },
    "exchange_rates": {
        "invalid_rate_date": {"rate_date": "bad"},
        "invalid_currency_code": {"currency_code": "EURO"},
        "invalid_rate_to_inr": {"rate_to_inr": "0"},
        "invalid_inr_rate": {"currency_code": "INR", "rate_to_inr": "1.01"},
        "duplicate_exchange_rate": {"currency_code": " gbp "},
    },
}


def unique_id(table: str, n: int) -> dict[str, str]:
    key = SPECS[table].key
    if len(key) == 1:
        return {key[0]: f"{table}-{n}"}
    return {"rate_date": f"2023-01-{n + 1:02d}"}


@pytest.mark.parametrize("table", list(RULE_REASONS))
def test_each_rule(spark, table):
    rules = list(RULE_REASONS[table])
    assert list(BAD_CELLS[table]) == rules
    rows = [row(table)]
    for n, rule in enumerate(rules):
        keep_id = {} if rule.startswith("duplicate") else unique_id(table, n)
        rows.append(row(table, **{**keep_id, **BAD_CELLS[table][rule]}))
    tagged = validate.tagged_table(table, sources(spark, **{table: rows})).cache()
    spec = SPECS[table]
    rejected = validate.rejected_rows(spec, tagged).orderBy("_raw_id").collect()
    assert [r["failed_rule"] for r in rejected] == rules
    assert [r["rejection_reason"] for r in rejected] == list(RULE_REASONS[table].values())
    assert [r["_raw_id"] for r in validate.valid_rows(tagged).collect()] == [0]
    counts = {r["rule_name"]: r for r in validate.rule_counts(spec, tagged).collect()}
    assert list(counts) == rules
    for rule in rules:
        assert counts[rule]["records_failed"] >= 1 and counts[rule]["records_rejected"] == 1
        assert counts[rule]["records_checked"] == len(rows)
    tagged.unpersist()


def test_first_rule_wins_and_all_hits_count(spark):
    rows = [row("customers"), row("customers", customer_id="C-2", email="x", customer_segment="?")]
    tagged = validate.tag(SPECS["customers"], text_frame(spark, "customers", rows))
    rejected = validate.rejected_rows(SPECS["customers"], tagged).collect()
    assert [r["failed_rule"] for r in rejected] == ["invalid_email_format"]
    dq = {r["rule_name"]: r for r in validate.dq_rows({"customers": tagged}).collect()}
    assert set(dq) == {"invalid_email_format", "invalid_customer_segment", OVERALL_RULE}
    assert dq["invalid_customer_segment"]["records_failed"] == 1
    assert dq[OVERALL_RULE]["records_failed"] == 1
    assert dq[OVERALL_RULE]["records_checked"] == 2


def test_duplicate_counts_even_if_the_first_is_rejected(spark):
    rows = [row("customers", email=""), row("customers"), row("customers", city="Hull")]
    tagged = validate.tag(SPECS["customers"], text_frame(spark, "customers", rows))
    rejected = validate.rejected_rows(SPECS["customers"], tagged).orderBy("_raw_id").collect()
    assert [r["failed_rule"] for r in rejected] == [
        "required_email", "duplicate_customer_id", "duplicate_customer_id"
    ]
    blanks = [row("customers", customer_id="") for _ in range(3)]
    tagged = validate.tag(SPECS["customers"], text_frame(spark, "customers", blanks))
    counts = {r["rule_name"]: r["records_failed"] for r in
              validate.rule_counts(SPECS["customers"], tagged).collect()}
    assert (counts["required_customer_id"], counts["duplicate_customer_id"]) == (3, 0)


def test_a_bad_customer_takes_its_orders_along(spark):
    raw = sources(spark, customers=[row("customers", email="")])
    tagged = validate.validate_all(raw)
    failed = {
        name: [r["failed_rule"] for r in validate.rejected_rows(SPECS[name], df).collect()]
        for name, df in tagged.items()
    }
    assert failed == {
        "customers": ["required_email"],
        "products": [],
        "stores": [],
        "orders": ["orphan_customer_id"],
        "order_items": ["orphan_order_id"],
        "payments": ["orphan_order_id"],
        "deliveries": ["orphan_order_id"],
        "exchange_rates": [],
    }


def test_stores_with_one_bad_date(spark):
    rows = [
        row("stores", store_id=f"S-{i}", opening_date=d)
        for i, d in enumerate(["2020-01-15", "not-a-date", "2018-06-01"])
    ]
    tagged = validate.tag(SPECS["stores"], text_frame(spark, "stores", rows))
    valid = validate.valid_rows(tagged).orderBy("_raw_id").collect()
    assert [str(r["opening_date"]) for r in valid] == ["2020-01-15", "2018-06-01"]
    assert validate.rejected_rows(SPECS["stores"], tagged).first()["failed_rule"] == "invalid_opening_date"


@pytest.mark.parametrize(
    "quantity, valid",
    [("3", True), (" 4.0 ", True), ("1e2", True), ("0", False), ("-1", False), ("inf", False),
     ("nan", False), ("2d", False), ("", False), ("1_0", False), ("99999999999", False)],
)
def test_quantities(spark, quantity, valid):
    raw = sources(spark, order_items=[row("order_items", quantity=quantity)])
    tagged = validate.tagged_table("order_items", raw)
    assert (validate.valid_rows(tagged).count() == 1) is valid


def test_accepted_oddities(spark):
    """Values that look wrong but that no rule forbids."""
    raw = sources(
        spark,
        order_items=[row("order_items", unit_price="0.0")],
        deliveries=[row("deliveries", delivery_time_minutes="0")],
        orders=[row("orders", currency=" gbp ", sales_channel="mobile_app")],
    )
    tagged = validate.validate_all(raw)
    assert [validate.valid_rows(tagged[t]).count() for t in ("order_items", "deliveries")] == [1, 1]
    assert validate.valid_rows(tagged["orders"]).first()["currency"] == "GBP"


def test_reject_json_shows_the_normalised_row(spark):
    rows = [row("exchange_rates", rate_date="x", currency_code=" usd", rate_to_inr="83.50")]
    tagged = validate.tag(SPECS["exchange_rates"], text_frame(spark, "exchange_rates", rows))
    reject = rejects.reject_rows(SPECS["exchange_rates"], tagged, 4).first()
    assert reject["original_record"] == '{"rate_date":null,"currency_code":"USD","rate_to_inr":83.5}'
    assert (reject["record_identifier"], reject["pipeline_run_id"]) == ("USD|", 4)


def test_gate_messages_and_empty_tables(spark):
    rows = [("customers", OVERALL_RULE, 10, 1), ("products", OVERALL_RULE, 0, 0), ("stores", OVERALL_RULE, 20, 1)]
    dq = spark.createDataFrame(rows, "table_name string, rule_name string, records_checked bigint, records_failed bigint")
    passed, overall, messages = validate.gate(validate.quality_scores(dq))
    assert not passed and round(overall, 4) == round(28 / 30 * 100, 4)
    assert "customers" in messages[0] and "90.00%" in messages[0] and "95.00%" in messages[0]
    # Empty and absent tables fail as well.
    assert len(messages) == 7 and all("0.00%" in m for m in messages[1:]) and "products" in messages[1]
    whole = [(t, OVERALL_RULE, 20, 1) for t in C.SOURCE_TABLES]
    ok, _, none = validate.gate(validate.quality_scores(spark.createDataFrame(whole, dq.schema)))
    assert ok and none == []


def test_numbers_beyond_the_load_type_are_rejected(spark):
    raw = sources(spark, products=[row("products", selling_price="20000000000")])
    tagged = validate.validate_all(raw)
    assert validate.valid_rows(tagged["products"]).count() == 0
    assert landing.staging_rows("products", validate.valid_rows(tagged["products"])).count() == 0


@pytest.mark.parametrize(
    "table, cell, inside, outside",
    [("products", "selling_price", "9999999999.994", "9999999999.995"),
     ("orders", "order_total", "999999999999.9949999", "999999999999.995"),
     ("deliveries", "delivery_time_minutes", "1440.4", "2147483647.5"),
     ("deliveries", "delivery_time_minutes", "1440", "-99999999999999999999")],
)
def test_load_types_end_where_rounding_leaves_them(spark, table, cell, inside, outside):
    keys = [{SPECS[table].key[0]: f"K-{i}"} for i in (1, 2)]
    rows = [row(table, **keys[0], **{cell: inside}), row(table, **keys[1], **{cell: outside})]
    tagged = validate.tagged_table(table, sources(spark, **{table: rows}))
    assert [r["_raw_id"] for r in validate.valid_rows(tagged).collect()] == [0]
    assert validate.rejected_rows(SPECS[table], tagged).first()["failed_rule"] == f"invalid_{cell.removesuffix('_minutes')}"


def test_arrivals_that_are_no_number_are_sorted_by_a_hash_first(spark, monkeypatch):
    monkeypatch.setattr(joins, "cut_lineage", lambda df, name: df)
    ids = ["ITEM-1", "ITEM-2", "ITEM-1", "ITEM-1", " ", "ITEM-2"]
    raw = text_frame(spark, "order_items", [row("order_items", order_item_id=i) for i in ids])
    raw = raw.withColumn("_raw_id", F.struct((9 - F.col("_raw_id")).alias("a"), F.col("_raw_id").cast("string").alias("b")))
    marked = validate.mark_duplicates(validate.normalise(SPECS["order_items"], raw), SPECS["order_items"])
    later = [int(r["_raw_id"]["b"]) for r in marked.where("_duplicate").collect()]
    assert sorted(later) == [0, 1, 2] and "_hash" not in marked.columns and "_first" not in marked.columns
    assert re.search(r"SortAggregate\(key=\[(_hash|_groupingexpression)#", marked._jdf.queryExecution().executedPlan().toString())


def test_rare_date_spellings_leave_the_stage_small_enough_to_compile(spark):
    """The step of one table that judges records is compiled as one stage."""
    raw = sources(spark)
    for table in ("orders", "payments"):
        plan = validate.normalise(SPECS[table], raw[table])._jdf.queryExecution().debug().codegenToSeq()
        sizes = [int(plan.apply(i)._3().maxMethodCodeSize()) for i in range(plan.size())]
        assert sizes and max(sizes) < int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))


def test_tables_are_tagged_side_by_side(spark):
    together = threading.Barrier(sum(not spec.parents for spec in SPECS.values()))

    def keep(name, df):
        if not SPECS[name].parents:
            together.wait(timeout=60)
        return df

    tagged = validate.validate_all(sources(spark), keep)
    assert list(tagged) == list(C.SOURCE_TABLES)
    assert {name: df.count() for name, df in tagged.items()} == {name: 1 for name in C.SOURCE_TABLES}


def test_a_table_that_fails_ends_the_validation(spark):
    def keep(name, df):
        if name == "customers":
            raise OSError("disk full")
        return df

    with pytest.raises(OSError, match="disk full"):
        validate.validate_all(sources(spark), keep)
