"""Reject files: traceable metadata first, then the business columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.contracts import REJECT_COLUMNS
from tradeloom.operators.rules import TableSpec
from tradeloom.operators.validate import MALFORMED_RULE, rejected_rows


def reject_rows(spec: TableSpec, tagged: DataFrame, run_id: int) -> DataFrame:
    """Rejected records with the normalised row as JSON, NULLs kept."""
    rejected = rejected_rows(spec, tagged)
    shown = {n: F.col(n).cast("double") for n in spec.numbers}
    business = [shown.get(n, F.col(n)).alias(n) for n in spec.columns]
    as_json = F.to_json(F.struct(*business), {"ignoreNullFields": "false"})
    return rejected.select(
        F.lit(run_id).cast("bigint").alias("pipeline_run_id"),
        F.lit(spec.name).alias("source_table"),
        "record_identifier",
        "rejection_reason",
        "failed_rule",
        as_json.alias("original_record"),
        *business,
    )


def malformed_rows(spec: TableSpec, lines: DataFrame, text: str, run_id: int) -> DataFrame:
    """Reject rows of lines that could not be read as records: their text, and no business columns."""
    types = {n: "double" for n in spec.numbers} | {n: "date" for n in spec.dates}
    return lines.select(
        F.lit(run_id).cast("bigint").alias("pipeline_run_id"),
        F.lit(spec.name).alias("source_table"),
        F.lit("").alias("record_identifier"),
        F.lit("The line's cells do not fit its header").alias("rejection_reason"),
        F.lit(MALFORMED_RULE).alias("failed_rule"),
        F.col(text).alias("original_record"),
        *[F.lit(None).cast(types.get(n, "string")).alias(n) for n in spec.columns],
    )


def write_rejects(rows: DataFrame, directory: str, table: str) -> str:
    """Rewrite a table's reject files; an empty set still leaves a header."""
    path = f"{directory}/{table}_rejected"
    if rows.columns[: len(REJECT_COLUMNS)] != list(REJECT_COLUMNS):
        raise ValueError("reject rows must start with the reject metadata")
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
