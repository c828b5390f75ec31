"""Upserts over plain columnar tables.

Each function returns the whole new state of the target; writing it beside the
old state and switching over is the table layer's job, so a path that is being
read is never overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.operators.keys import dense_keys
from tradeloom.session import cut_lineage


def _matched(target: DataFrame, source: DataFrame, key: str, update: list[str]) -> tuple[DataFrame, list[Column]]:
    """Rows of either side met on ``key``, in one exchange of each, and the columns that they become."""
    old = target.select(F.col(key), F.struct(*target.columns).alias("_old"))
    new = source.select(F.col(key), F.struct(*source.columns).alias("_new"))
    known, incoming = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    types = dict(target.dtypes)

    def value(c: str) -> Column:
        before = F.col(f"_old.{c}")
        if c not in source.columns:
            return before.alias(c)
        after = F.col(f"_new.{c}").cast(types[c])
        return F.when(incoming & (~known | F.lit(c in update)), after).otherwise(before).alias(c)

    return old.join(new, key, "full_outer"), [value(c) for c in target.columns]


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str | None = None,
    update: list[str] | None = None,
    highest: int | None = None,
) -> DataFrame:
    """Insert new keys, overwrite ``update`` columns of known keys, keep the rest.

    Rows absent from the source stay.  Known rows keep their surrogate key; new
    ones are numbered on from ``highest``, the target's maximum unless the
    caller knows it.  Both inputs are unique on ``key`` and read once.
    """
    update = [c for c in (update or source.columns) if c not in (key, surrogate)]
    met, columns = _matched(target, source, key, update)
    if not surrogate:
        return met.select(*columns)
    met = cut_lineage(met.select(*columns), "met")
    first = highest if highest is not None else met.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    fresh = met.where(F.col(surrogate).isNull()).drop(surrogate)
    kept = met.where(F.col(surrogate).isNotNull())
    return kept.unionByName(dense_keys(fresh, key, surrogate, start=first))


def update_only(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Refresh one column where the source has the key; unknown keys are ignored."""
    incoming = source.select(F.col(key), F.col(column).alias("_new"))
    return (
        target.join(incoming, key, "left")
        .withColumn(column, F.coalesce("_new", column))
        .select(target.columns)
    )


def insert_if_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Add only rows whose key the target lacks; nothing is overwritten."""
    return target.unionByName(source.join(target.select(key), key, "left_anti"))
