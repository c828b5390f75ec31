"""Jobs that had become smaller, or dearer than their input, over rows made here."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tradeloom.functions.parse import parse_date
from tradeloom.functions.text import collapse_blanks, norm_text
from tradeloom.operators import joins as lookups, keys, validate
from tradeloom.operators.rules import SPECS
from tradeloom.queries import QUERIES, Sample
from tradeloom.session import cut_lineage
from tradeloom.sources.sample import TABLE_SCHEMAS
from tests.fixtures import row, sources

ROWS = {
    "region": [(0, "R")],
    "nation": [(0, "N", 0)],
    "customer": [(1, "Customer#1", 0, 1.0, "BUILDING")],
    "supplier": [(0, "Supplier#0", 0, 1.0)],
    "part": [(1, "p", "b", "ECONOMY", 1, 10.0)],
    "orders": [(k, 1, "F", 10.0, datetime(1995, 1, day), "5-LOW") for k, day in ((1, 2), (2, 9))],
    "lineitem": [(1, 1, 1, 1, 1.0, 10.0, 0.0, 0.0, "N", "O", datetime(1995, 1, 3))],
    "events": [(1, datetime(1995, 1, 2), 1, "click", 1.0, "")],
}


def sample_tables(spark, path, **changed):
    for name, rows in {**ROWS, **changed}.items():
        spark.createDataFrame(rows, TABLE_SCHEMAS[name]).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_days_without_orders_have_their_rates_and_dates(spark, tmp_path):
    directory = sample_tables(spark, tmp_path)
    between = [date(1995, 1, d) for d in range(2, 10)]
    for name in ("dim_date_from_data", "dim_date"):
        days = {r["full_date"] for r in QUERIES[name](spark, directory).collect()}
        assert days >= set(between)
    rates = Sample(spark, directory).tables.dated_tables()["exchange_rates"]
    assert sorted(r["rate_date"] for r in rates.where("currency_code = 'INR'").collect()) == between


def joins(df):
    """The joins of a frame's plan, the last one first, with the columns that their left sides bring."""
    found, left = [], [df._jdf.queryExecution().optimizedPlan()]
    while left:
        node = left.pop(0)
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            output = children[0].output()
            found.append((node.simpleString(1000), {output.apply(i).name() for i in range(output.size())}))
        left += children[:1]
    return found


def test_records_meet_others_as_one_integer(spark, tmp_path):
    sample = Sample(spark, sample_tables(spark, tmp_path))
    met = joins(validate.rule_counts(SPECS["order_items"], sample.tagged("order_items")))
    assert len(met) == 3
    for _, columns in met:
        assert validate.HITS in columns and not columns & {"quantity", "unit_price", "discount_percent"}


def test_lines_grouped_by_product_meet_it_last(spark, tmp_path):
    sample = Sample(spark, sample_tables(spark, tmp_path))
    assert "product_id" in joins(sample.mart("product_performance"))[0][0]
    assert "order_id" in joins(sample.mart("category_performance"))[0][0]
    shares = QUERIES["product_share"](spark, str(tmp_path)).collect()
    assert [(r["product_id"], r["revenue_share"]) for r in shares] == [("PRD-1", 1.0)]


def test_blanks_of_any_kind_are_collapsed_as_before(spark):
    values = ["a", "a b", " x", "café", "a  b", "\x7f", "", None, "2020-01-15\n", "2020-01-5T", "2020-02-30"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(norm_text(F.col("v")), collapse_blanks(F.coalesce("v", F.lit(""))), parse_date(F.col("v"))).collect()
    assert all(r[0] == r[1] for r in rows)
    assert [r[2] for r in rows[-3:]] == [date(2020, 1, 15), None, None]


def test_stored_rows_are_numbered_without_another_copy(spark, monkeypatch):
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    written = []
    monkeypatch.setattr(keys, "cut_lineage", lambda df, name="rows": written.append(name) or cut_lineage(df, name))
    numbered = [keys.dense_keys(df, "k", "sk", start=5, parts=7, stored=stored) for stored in (False, True)]
    assert written == ["numbered"]
    first, second = ({r["k"]: r["sk"] for r in n.collect()} for n in numbered)
    assert first == second and sorted(first.values()) == list(range(6, 1006))


def test_rows_meet_only_exceptions_of_what_is_too_large_to_broadcast(spark, monkeypatch):
    lines = [row("order_items", order_item_id=f"ITEM-{i // 2 if i < 4 else i}") for i in range(8)]
    lines += [row("order_items", order_item_id=f"ODD-{p}", product_id=p) for p in ("PRD-X", "PRD-4", "")]
    products = [row("products"), row("products", product_id="PRD-4", unit_cost="-1")]
    raw = sources(spark, order_items=lines, products=products)
    hits = lambda: sorted(tuple(r) for r in validate.tagged_table("order_items", raw).select("_raw_id", "_hits").collect())
    expected = hits()
    written = []
    monkeypatch.setattr(lookups, "cut_lineage", lambda df, name: written.append(df.collect()) or cut_lineage(df, name))
    monkeypatch.setattr(lookups, "BROADCAST_INPUT_LIMIT", -1)
    monkeypatch.setattr(validate, "MANY_PER_PARENT", 0)
    assert hits() == expected and sum(h != 0 for _, h in expected) == 5
    assert {"ITEM-0", "ITEM-1"} in [{r[0] for r in rows} for rows in written]
    assert {"PRD-X", "PRD-4", ""} in [{r[0] for r in rows} for rows in written]


def test_parents_that_arrive_together_are_met_as_often(spark, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("b",)], "k string")
    parents = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    seen = lambda: sorted(map(str, validate.mark_known(df, "k", parents).collect()))
    expected = seen()
    monkeypatch.setattr(lookups, "BROADCAST_INPUT_LIMIT", -1)
    assert seen() == expected
    monkeypatch.setattr(validate, "MANY_PER_PARENT", 0)
    assert seen() == expected and len(expected) == 7
