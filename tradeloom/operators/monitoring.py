"""Run ledger as an append-only event table, and its current state."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.contracts import RUN_LEDGER_SCHEMA

START, FINISH = "START", "FINISH"


def ledger_state(events: DataFrame) -> DataFrame:
    """One row per run: when it began and ended, and what its last event says."""
    last = F.struct(
        "status",
        "records_extracted",
        "records_validated",
        "records_rejected",
        "records_loaded",
        "quality_score",
        "error_message",
    )
    # A finish outranks a start with the same clock reading.
    order = F.struct(F.col("event") == FINISH, F.col("event_ts"))
    return (
        events.groupBy("run_id")
        .agg(
            F.max("pipeline_name").alias("pipeline_name"),
            F.min(F.when(F.col("event") == START, F.col("event_ts"))).alias("started_at"),
            F.max(F.when(F.col("event") == FINISH, F.col("event_ts"))).alias("completed_at"),
            F.max_by(last, order).alias("_last"),
        )
        .select("run_id", "pipeline_name", "started_at", "completed_at", "_last.*")
    )


def ledger_event(spark: SparkSession, run_id: int, pipeline: str, event: str, **values) -> DataFrame:
    """A one-row ledger event stamped with the current time."""
    row = {name: values.get(name) for name in RUN_LEDGER_SCHEMA}
    row.update(
        run_id=run_id, pipeline_name=pipeline, event=event, event_ts=datetime.now(timezone.utc)
    )
    ddl = ", ".join(f"{name} {kind}" for name, kind in RUN_LEDGER_SCHEMA.items())
    return spark.createDataFrame([row], ddl)
