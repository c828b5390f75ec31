"""CSV extracts: every column text, blanks kept, arrival order recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradeloom.contracts import SOURCE_TABLES
from tradeloom.sources.tables import exists


#: Column that holds the text of a line whose cells do not fit the header.
MALFORMED = "_malformed"


def read_csv(spark: SparkSession, path: str, multi_line: bool = True, keep_malformed: bool = False) -> DataFrame:
    """One extract (a file, or a folder of files) without type inference.

    Quotes are escaped by doubling, and a quoted cell may hold line breaks; so a
    file is read by one task, and a large table is a folder of many files.
    ``multi_line=False`` reads files split, for extracts without such cells.
    All files of a folder have the same header: one whose columns differ, or
    come in another order, fails the read.  So does a line with more or fewer
    cells than its header, unless ``keep_malformed``: then the row has the
    line's text in ``_malformed``, which is null in all other rows.
    ``_raw_id`` rises along a file.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    names = reader.option("inferSchema", False).csv(path).columns
    kept = [MALFORMED] if keep_malformed else []
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, *kept]])
    reader = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", MALFORMED)
    scan = reader.option("mode", "PERMISSIVE" if keep_malformed else "FAILFAST").csv(path)
    return scan.select(
        F.monotonically_increasing_id().alias("_raw_id"),
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names],
        *kept,
    )


def extract(
    spark: SparkSession, directory: str, multi_line: bool = True, keep_malformed: bool = False
) -> dict[str, DataFrame]:
    """The eight extracts; a missing folder or file is an error before anything is read."""
    if not exists(spark, directory):
        raise FileNotFoundError(f"input directory not found: {directory}")
    paths = {name: f"{directory}/{name}.csv" for name in SOURCE_TABLES}
    for path in paths.values():
        if not exists(spark, path):
            raise FileNotFoundError(f"missing source extract: {path}")
    return {name: read_csv(spark, path, multi_line, keep_malformed) for name, path in paths.items()}
