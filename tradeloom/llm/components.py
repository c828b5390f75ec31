"""Connected components of a links table, without ever gathering it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the neighbours of each node to its smallest one; the larger neighbours, or the others."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges  # u > v here, so v are the smaller neighbours
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            least.select("u", F.col("least").alias("v"))
        )
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, class_id): for every id of a links table (a, b), the smallest id it is connected with.

    Alternates large-star and small-star steps; each round is a written table.
    Rounds grow with the logarithm of the longest chain.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = _state(edges)
    while before[0]:
        edges = written(_star(_star(edges, True), False), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("class_id")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("class_id")).distinct()
    )
