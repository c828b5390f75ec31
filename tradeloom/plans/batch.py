"""The batch run: extract, land, validate, reject, gate, stage, load, close the ledger.

Lineage is cut at written tables: raw rows, tagged rows and incoming facts are
written once to shared storage and read back, so a lost executor costs a task
and never a recomputation of the whole cascade.
"""

from __future__ import annotations

import traceback
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom import contracts as C
from tradeloom.operators import checks, dims, facts, landing, rejects, validate
from tradeloom.operators.keys import dense_keys
from tradeloom.operators.merge import upsert
from tradeloom.operators.monitoring import FINISH, START, ledger_event, ledger_state
from tradeloom.operators.rules import SPECS
from tradeloom.plans import marts
from tradeloom.session import configure, shared_dir
from tradeloom.sources.csv_scan import MALFORMED, extract
from tradeloom.sources.tables import MonthlyTable, Snapshot, Table, delete

#: Facts: how they are built, and their business and surrogate keys.
FACTS = {
    "fact_sales": ("source_order_item_id", "sales_key", C.FACT_SALES_SCHEMA),
    "fact_delivery": ("delivery_id", "delivery_key", C.FACT_DELIVERY_SCHEMA),
}

PIPELINE = "retail_batch"
SUCCESS, FAILED, RUNNING = "SUCCESS", "FAILED", "RUNNING"


@dataclass
class RunReport:
    """What a run did; ``exit_code`` is 0 only for a completed load."""

    run_id: int
    status: str = RUNNING
    extracted: int = 0
    validated: int = 0
    rejected: int = 0
    loaded: int = 0
    quality_score: float = 0.0
    error_message: str | None = None
    gate_messages: list[str] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return 0 if self.status == SUCCESS else 1


class Warehouse:
    """Locations of the tables under one warehouse folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def table(self, layer: str, name: str) -> Table:
        return Table(self.spark, f"{self.path}/{layer}/{name}")

    @property
    def ledger(self) -> Table:
        return self.table("monitoring", "run_events")

    @property
    def dq(self) -> Table:
        return self.table("monitoring", "data_quality_results")

    def runs(self) -> DataFrame:
        events = checks.add_missing_columns(self.ledger.rows(), C.RUN_LEDGER_SCHEMA)
        return ledger_state(events)

    @property
    def raw(self) -> Snapshot:
        """The eight raw tables, which change together."""
        return Snapshot(self.spark, f"{self.path}/raw")

    def fact(self, name: str) -> MonthlyTable:
        key, surrogate, _ = FACTS[name]
        return MonthlyTable(self.spark, f"{self.path}/warehouse/{name}", key, surrogate)

    def dimension(self, name: str) -> DataFrame:
        """A table of the star; a fact without the month it is stored by."""
        if name in FACTS:
            return self.fact(name).read().drop("month")
        return self.table("warehouse", name).read()

    def mart(self, name: str) -> DataFrame:
        """A reporting mart over the loaded star."""
        if name == "delivery_performance":
            fact = self.dimension("fact_delivery")
            return marts.delivery_mart(fact, {"dim_channel": self.dimension("dim_channel")})
        dim_name = marts.SALES_MARTS[name][0]
        fact = self.dimension("fact_sales")
        return marts.sales_mart(name, fact, {dim_name: self.dimension(dim_name)})


def run_batch(
    spark: SparkSession,
    inputs: str,
    warehouse_path: str,
    rejects_path: str,
    threshold: float = C.QUALITY_THRESHOLD,
    multi_line: bool = True,
    fx_fallback: str = "latest",
) -> RunReport:
    """Run the whole batch once.  Failures are recorded in the ledger, not raised.

    ``multi_line=False`` reads extracts split, where no cell has a line break.
    ``fx_fallback`` says which rate stands in for a missing one: the currency's
    ``latest``, or the last on or before the day (``asof``).
    """
    configure(spark)
    warehouse = Warehouse(spark, warehouse_path)
    report = RunReport(_open_run(warehouse))
    work = f"{shared_dir(spark, warehouse_path)}/tradeloom-work/run-{report.run_id}"
    try:
        landed = _land(warehouse, extract(spark, inputs, multi_line, keep_malformed=True))
        malformed = {name: df.where(F.col(MALFORMED).isNotNull()) for name, df in landed.items()}
        raw = {name: df.where(F.col(MALFORMED).isNull()).drop(MALFORMED) for name, df in landed.items()}
        tagged = validate.validate_all(raw, keep=lambda n, df: _written(df, f"{work}/tagged/{n}"))
        for name, df in tagged.items():
            rows = rejects.reject_rows(SPECS[name], df, report.run_id)
            lines = rejects.malformed_rows(SPECS[name], malformed[name], MALFORMED, report.run_id)
            rejects.write_rejects(rows.unionByName(lines), rejects_path, name)
        if _gate(warehouse, tagged, malformed, threshold, report):
            valid = _stage(warehouse, tagged)
            _load(warehouse, valid, work, report, fx_fallback)
            report.status = SUCCESS
    except Exception as error:  # the ledger must learn about any failure
        report.status = FAILED
        report.error_message = f"{error}\n{traceback.format_exc()}"
    finally:
        delete(spark, work)  # what the run kept for itself
    _close_run(warehouse, report)
    return report


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _open_run(warehouse: Warehouse) -> int:
    events = warehouse.ledger.rows()
    last = events.agg(F.max("run_id")).first()[0] if events is not None else 0
    run_id = (last or 0) + 1
    warehouse.ledger.append(
        ledger_event(warehouse.spark, run_id, PIPELINE, START, status=RUNNING)
    )
    return run_id


def _close_run(warehouse: Warehouse, report: RunReport) -> None:
    warehouse.ledger.append(
        ledger_event(
            warehouse.spark,
            report.run_id,
            PIPELINE,
            FINISH,
            status=report.status,
            records_extracted=report.extracted,
            records_validated=report.validated,
            records_rejected=report.rejected,
            records_loaded=report.loaded,
            quality_score=Decimal(f"{report.quality_score:.2f}"),
            error_message=report.error_message,
        )
    )


def _land(warehouse: Warehouse, extracted: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All extracts as raw tables, in force together or not at all."""
    return warehouse.raw.replace({name: landing.raw_rows(name, df, (MALFORMED,)) for name, df in extracted.items()})


def _gate(
    warehouse: Warehouse,
    tagged: dict[str, DataFrame],
    malformed: dict[str, DataFrame],
    threshold: float,
    report: RunReport,
) -> bool:
    """Record the quality results, then decide; about seventy rows reach the driver."""
    rows = validate.dq_rows(tagged, malformed).select(
        F.lit(report.run_id).cast("bigint").alias("run_id"),
        "*",
        F.current_timestamp().alias("created_at"),
    )
    warehouse.dq.append(rows)
    recorded = warehouse.dq.rows().filter(F.col("run_id") == report.run_id)
    scores = validate.quality_scores(recorded, threshold).cache()
    totals = validate.overall_score(scores).first()
    passed, overall, messages = validate.gate(scores, threshold)
    scores.unpersist()
    report.extracted = totals["records_checked"]
    report.rejected = totals["records_rejected"]
    report.validated = report.extracted - report.rejected
    report.quality_score = overall
    report.gate_messages = messages
    if not passed:
        report.status = FAILED
        report.error_message = "below the quality threshold: " + "; ".join(messages)
    return passed


def _stage(warehouse: Warehouse, tagged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write staging tables; loading goes on from the tagged rows at full precision."""
    valid = {name: validate.valid_rows(df) for name, df in tagged.items()}
    for name, df in valid.items():
        warehouse.table("staging", name).replace(landing.staging_rows(name, df))
    return valid


def _merge(
    table: Table, incoming: DataFrame, key: str, surrogate: str | None = None
) -> DataFrame:
    """Upsert into a table, creating it on the first load."""
    if not table.is_empty():
        return table.replace(upsert(table.read(), incoming, key, surrogate))
    return table.replace(dense_keys(incoming, key, surrogate) if surrogate else incoming)


def _seed(table: Table, seed: DataFrame, key: str) -> DataFrame:
    """Seed a reference dimension without touching rows it already has."""
    if table.is_empty():
        return table.replace(seed)
    return table.replace(dims.seeded(table.read(), seed, key))


def _load(
    warehouse: Warehouse, valid: dict[str, DataFrame], work: str, report: RunReport, fx_fallback: str
) -> None:
    spark = warehouse.spark
    calendar = warehouse.table("warehouse", "dim_date")
    _seed(calendar, dims.calendar_seed(spark), "date_key")
    _merge(calendar, dims.dates_in_data(valid), "date_key")
    loaded = {}
    for name, (table, business, surrogate) in dims.DIM_KEYS.items():
        rows = dims.dimension(table, valid[table], unique=True)
        loaded[name] = _merge(warehouse.table("warehouse", name), rows, business, surrogate)
    _seed(warehouse.table("warehouse", "dim_channel"), dims.dim_channel(spark), "channel_key")
    methods = warehouse.table("warehouse", "dim_payment_method")
    _seed(methods, dims.dim_payment_method(spark), "payment_method_key")
    currencies = warehouse.table("warehouse", "dim_currency")
    _seed(currencies, dims.dim_currency(spark), "currency_key")
    currencies.replace(dims.refresh_currency_rates(currencies.read(), valid["exchange_rates"]))

    report.loaded = sum(df.count() for df in loaded.values())
    built = {"fact_sales": facts.fact_sales(valid, loaded, fx_fallback), "fact_delivery": facts.fact_delivery(valid, loaded)}
    for name, incoming in built.items():
        report.loaded += warehouse.fact(name).merge(checks.require_types(incoming, FACTS[name][2]))
