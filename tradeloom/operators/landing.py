"""Raw landing and staging projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.contracts import SOURCE_SCHEMAS
from tradeloom.operators.dims import contract_columns


def raw_rows(table: str, extracted: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Contract columns as text, blank instead of NULL, with arrival order and time; ``more`` columns as they come."""
    present = set(extracted.columns)
    text = [
        (F.coalesce(F.col(n).cast("string"), F.lit("")) if n in present else F.lit("")).alias(n)
        for n in SOURCE_SCHEMAS[table]
    ]
    return extracted.select("_raw_id", *text, *more, F.current_timestamp().alias("_ingested_at"))


def staging_rows(table: str, valid: DataFrame) -> DataFrame:
    """Valid rows in load types with their quality flags."""
    return valid.select(
        *contract_columns(table),
        F.lit(True).alias("_is_valid"),
        F.lit("PASSED").alias("_dq_status"),
        F.lit(None).cast("string").alias("_rejection_reason"),
        F.current_timestamp().alias("_processed_at"),
    )


def extract_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows per source table, in one job."""
    parts = [
        df.agg(F.count("*").alias("records_extracted")).select(
            F.lit(name).alias("table_name"), "records_extracted"
        )
        for name, df in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
