"""Joins to a side that is unique on its key, with a size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.session import cut_lineage

# Compressed input bytes a broadcast side may be built from.  Small enough that
# the hash table stays a few hundred MB even at a tenfold in-memory blow-up.
BROADCAST_INPUT_LIMIT = 16 * 1024 * 1024


def input_bytes(df: DataFrame) -> int | None:
    """Bytes the plan scans, from file metadata only; None when not knowable.

    A lookup side is built by projections and lookups that never add rows (or
    is a calendar, which its days bound), so what it scans bounds what it holds.
    """
    jdf = getattr(df, "_jdf", None)
    if jdf is None:
        return None
    leaves = jdf.queryExecution().analyzed().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        total += int(leaves.apply(i).stats().sizeInBytes())
    return total


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join many rows to at most one row of ``right`` each.

    Below the limit the right side is broadcast, so ``left`` keeps its
    partitioning and no key can be hot.  Above it (or where the size is not
    known) Spark plans a shuffle join; ``right`` has one row per key, so an
    adaptive skew split of a hot key copies a single row.
    """
    size = input_bytes(right)
    if size is not None and size <= BROADCAST_INPUT_LIMIT:
        right = F.broadcast(right)
    return left.join(right, on, how)


def exceptions_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """``lookup_join`` to the few exceptions found among many rows.

    How few there are no file says, so above the limit they are written and the
    size of what was written decides: as a rule ``left`` is not moved then.
    """
    size = input_bytes(right)
    if size is not None and size > BROADCAST_INPUT_LIMIT:
        right = cut_lineage(right, "exceptions")
    return lookup_join(left, right, on, how)
