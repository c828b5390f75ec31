"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradeloom.session import cut_lineage

#: Hex digits of an MD5 that choose a part, and how many values they have.
PART_DIGITS, PART_VALUES = 8, 1 << 32


def digest_part(digest: Column, parts: int) -> Column:
    """Which of equal ranges of MD5 digests one lies in; rises with the digest."""
    place = F.conv(F.substring(digest, 1, PART_DIGITS), 16, 10).cast("bigint")
    return F.shiftright(place * F.lit(parts), 32).cast("int")


def dense_keys(
    df: DataFrame,
    business_key: str,
    surrogate: str,
    start: Column | int | None = None,
    parts: int | None = None,
    stored: bool = False,
    columns: list[str] | None = None,
    write: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Number rows ``start+1 .. start+n`` by the key's MD5, equal digests by the key.

    Digests spread evenly however ids are spelled, so ranges of them need no
    sampling: each is numbered by itself, in one exchange over which ``df`` is
    evaluated once; the digests themselves are not moved.  The numbered rows are written, and the sizes of the parts,
    read from there, become their offsets.  ``parts`` is the session's number of
    shuffle partitions unless given; it does not change the result, which depends
    on the data only, so a recomputed task hands out the same keys.  Rows that are
    ``stored`` already, or cost no more than a read, are not written again: the
    sizes are counted from their keys.  ``columns`` are those to return beside the
    number, all unless given; ``write`` stands in for ``cut_lineage``.
    """
    columns = columns or df.columns
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digest = F.md5(F.col(business_key).cast("string"))
    placed = df.withColumn("_part", digest_part(digest, parts))
    position = F.row_number().over(W.partitionBy("_part").orderBy("_digest", business_key))
    numbered = placed.repartition("_part").withColumn("_digest", digest).select("_part", *columns, position.alias("_position"))
    # A row per part; their number is a setting, not the data's.
    if stored:
        sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    else:
        numbered = (write or cut_lineage)(numbered, "numbered")
        sizes = numbered.groupBy("_part").agg(F.max("_position").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    first = start if isinstance(start, Column) else F.lit(start or 0).cast("bigint")
    key = (first + F.col("_offset") + F.col("_position")).cast("bigint")
    return numbered.join(F.broadcast(offsets), "_part").select(key.alias(surrogate), *columns)
