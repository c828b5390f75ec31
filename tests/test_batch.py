"""The whole batch on CSV files: load, gate, idempotency, failure."""

import csv
import glob
import os
from decimal import Decimal

import pytest

from tests.fixtures import row, write_csvs
from tradeloom.plans.batch import Warehouse, run_batch
from tradeloom.plans.marts import SALES_MARTS
from tradeloom.sources.csv_scan import extract, read_csv


def run(spark, tmp_path, **rows):
    inputs = write_csvs(str(tmp_path / "in"), **rows)
    return run_batch(spark, inputs, str(tmp_path / "wh"), str(tmp_path / "rejects"))


def test_load_builds_star_and_marts(spark, tmp_path):
    report = run(spark, tmp_path)
    assert (report.status, report.exit_code, report.error_message) == ("SUCCESS", 0, None)
    assert (report.extracted, report.validated, report.rejected) == (8, 8, 0)
    assert report.loaded == 5
    assert report.quality_score == 100.0
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    sale = warehouse.dimension("fact_sales").collect()[0]
    assert sale["net_amount"] == Decimal("202.50")
    assert sale["net_amount_inr"] == Decimal("21363.75")
    assert (sale["sales_key"], sale["customer_key"], sale["currency_key"]) == (1, 1, 3)
    assert (sale["payment_method_key"], sale["date_key"]) == (3, 20240203)
    assert "order_total" not in sale.asDict()
    for name in SALES_MARTS:
        mart = warehouse.mart(name).collect()
        assert len(mart) == 1 and mart[0]["sales"] == Decimal("21363.75"), name
    assert warehouse.mart("delivery_performance").collect()[0]["avg_time_minutes"] == 95.0
    state = warehouse.runs().collect()
    assert [(r["run_id"], r["status"], r["records_loaded"]) for r in state] == [(1, "SUCCESS", 5)]
    assert state[0]["completed_at"] >= state[0]["started_at"]
    currency = {r["currency_code"]: r["rate_to_inr"] for r in warehouse.dimension("dim_currency").collect()}
    assert currency["GBP"] == Decimal("105.500000") and currency["USD"] == Decimal("83.500000")
    assert len(currency) == 12


def test_second_run_is_idempotent_and_updates(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    names = ("dim_customer", "dim_store", "dim_date", "fact_sales", "fact_delivery")
    stores = [row("stores"), row("stores", store_id="STR-10")]
    assert run(spark, tmp_path, stores=stores).exit_code == 0
    first = {n: sorted(map(str, warehouse.dimension(n).collect())) for n in names}
    assert run(spark, tmp_path, stores=stores).exit_code == 0
    assert {n: sorted(map(str, warehouse.dimension(n).collect())) for n in names} == first

    # A changed row, a new row, and a store the source no longer delivers.
    customers = [row("customers", customer_id="CUST-8"), row("customers", city="York")]
    assert run(spark, tmp_path, customers=customers).exit_code == 0
    rows = {r["customer_id"]: r for r in warehouse.dimension("dim_customer").collect()}
    assert (rows["CUST-7"]["customer_key"], rows["CUST-7"]["city"]) == (1, "York")
    assert rows["CUST-8"]["customer_key"] == 2
    kept = sorted(map(str, warehouse.dimension("dim_store").collect()))
    assert kept == first["dim_store"] and len(kept) == 2
    assert warehouse.runs().count() == 3


def test_failed_gate_stops_before_staging(spark, tmp_path):
    customers = [row("customers", customer_id=f"CUST-{i}") for i in range(9)]
    customers.append(row("customers", customer_id="CUST-X", email=""))
    report = run(spark, tmp_path, customers=customers)
    assert (report.exit_code, report.status, report.loaded) == (1, "FAILED", 0)
    assert all(x in report.error_message for x in ("customers", "90.00%", "95.00%"))
    assert "stores" not in report.error_message
    wh = tmp_path / "wh"
    assert not os.path.exists(wh / "staging") and not os.path.exists(wh / "warehouse")
    dq = Warehouse(spark, str(wh)).dq.rows().collect()
    failing = {(r["table_name"], r["rule_name"]): r["records_failed"] for r in dq if r["records_failed"]}
    assert failing == {("customers", "required_email"): 1, ("customers", "overall_table_quality"): 1}
    assert len(dq) == 9
    state = Warehouse(spark, str(wh)).runs().collect()[0]
    assert state["status"] == "FAILED" and state["records_loaded"] == 0


def test_reject_files_and_a_score_on_the_threshold(spark, tmp_path):
    customers = [row("customers", customer_id=f"CUST-{i}") for i in range(19)]
    customers.append(row("customers", customer_id=" CUST-X ", signup_date="2020-02-30"))
    assert run(spark, tmp_path, customers=customers).exit_code == 0
    files = glob.glob(str(tmp_path / "rejects" / "customers_rejected" / "*.csv"))
    rows = [r for f in files for r in csv.DictReader(open(f))]
    assert len(rows) == 1
    assert list(rows[0])[:6] == ["pipeline_run_id", "source_table", "record_identifier",
                                 "rejection_reason", "failed_rule", "original_record"]
    assert rows[0]["record_identifier"] == "CUST-X"
    assert rows[0]["failed_rule"] == "invalid_signup_date"
    assert '"signup_date":null' in rows[0]["original_record"]
    empty = glob.glob(str(tmp_path / "rejects" / "stores_rejected" / "*.csv"))
    assert [open(f).read().split(",")[0] for f in empty] == ["pipeline_run_id"]


def test_missing_input_fails_before_any_load(spark, tmp_path):
    inputs = write_csvs(str(tmp_path / "in"))
    with pytest.raises(FileNotFoundError):
        extract(spark, str(tmp_path / "nowhere"))
    (tmp_path / "in" / "stores.csv").unlink()
    with pytest.raises(FileNotFoundError, match="stores"):
        extract(spark, inputs)
    report = run_batch(spark, inputs, str(tmp_path / "wh"), str(tmp_path / "rejects"))
    assert report.exit_code == 1 and "stores.csv" in report.error_message
    assert not os.path.exists(tmp_path / "wh" / "raw")


def test_csv_scan_keeps_text(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(["a", "b", "c"])
        writer.writerow(["007", "", 'say "hi", ok'])
        writer.writerow([" NA ", "two\nlines", "nan"])
    rows = [tuple(r)[1:] for r in read_csv(spark, path).orderBy("_raw_id").collect()]
    assert rows == [("007", "", 'say "hi", ok'), (" NA ", "two\nlines", "nan")]


def test_a_line_with_a_surplus_cell_is_one_reject(spark, tmp_path):
    inputs = write_csvs(str(tmp_path / "in"), customers=[row("customers", customer_id=f"CUST-{i}") for i in range(7, 40)])
    with open(os.path.join(inputs, "customers.csv"), "a", newline="") as f:
        f.write("CUST-X,one,two\n")
    report = run_batch(spark, inputs, str(tmp_path / "wh"), str(tmp_path / "rejects"), fx_fallback="asof")
    assert (report.status, report.error_message) == ("SUCCESS", None)
    assert (report.extracted, report.rejected) == (41, 1)
    files = glob.glob(str(tmp_path / "rejects" / "customers_rejected" / "*.csv"))
    rejected = [r for f in files for r in csv.DictReader(open(f))]
    assert [(r["failed_rule"], r["original_record"]) for r in rejected] == [("malformed_record", "CUST-X,one,two")]
    dq = {(r["table_name"], r["rule_name"]): (r["records_checked"], r["records_failed"])
          for r in Warehouse(spark, str(tmp_path / "wh")).dq.rows().collect()}
    assert dq["customers", "malformed_record"] == dq["customers", "overall_table_quality"] == (34, 1)
    # The order's day has a rate of its own, so both fallbacks give the same.
    sale = Warehouse(spark, str(tmp_path / "wh")).dimension("fact_sales").collect()[0]
    assert sale["net_amount_inr"] == Decimal("21363.75")
