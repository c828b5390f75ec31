"""Nearest neighbours by a permutation index: vectors stand for the order of their nearest pivots.

1. Valid vectors, equal ones once, each with the ids that can ever be answers.
2. Pivots: a fixed number of vectors, those of the smallest hash.  Every vector
   keeps its nearest pivots in order, its permutation.
3. Rows and queries go to blocks.  A block of rows posts each row in the
   inverted files of its pivots, with the position.  A query reads the files of
   its own pivots; what it finds there adds up to the footrule distance.
4. The rows of the smallest footrule distance are reranked by the true inner
   product, and the best of all blocks merged.

Of two permutations cut after k pivots, absent pivots stand at position k, so
the distance is k (k + 1) - 2 * sum(k - max(a, b)) over the pivots that both
have, at positions a and b: files of other pivots need not be read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.llm.common import written

#: Pivots are a sample of this many vectors; a permutation is cut after the nearest PREFIX of them.
PIVOTS = 1024
PREFIX = 128
#: They are chosen from this many times as many, so that a large group of near copies gives few of them.
SAMPLE = 4
APART = 0.7
#: Share of a block's rows that are reranked, and how many at least.
SHARE = 0.12
LEAST = 500
#: Rows whose footrule distance is below this part of the greatest are reranked however many there are: of a dense group
#: the permutations are too much alike to choose by.
DENSE = 0.5
# Vectors and queries of a block; a task holds one of either.
BLOCK_ROWS = 16384
BLOCK_QUERIES = 1024


def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vector is neither null nor zero and holds only finite numbers, as 64-bit floats."""
    for batch in batches:
        vectors = batch.column(1)
        lengths = np.asarray(vectors.value_lengths().fill_null(0)).astype(np.int64)
        flat = vectors.flatten()  # leaves null vectors out
        values = np.asarray(flat.fill_null(math.nan)).astype(np.float64) + 0.0  # no negative zero
        ends = np.cumsum(lengths)
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        some = np.concatenate(([0], np.cumsum(values != 0)))
        good = np.flatnonzero((bad[ends] == bad[ends - lengths]) & (some[ends] > some[ends - lengths]))
        packed = [values[ends[i] - lengths[i] : ends[i]].tobytes() for i in good]
        yield pa.RecordBatch.from_pydict({"id": batch.column(0).take(pa.array(good)), "vec": pa.array(packed, pa.binary())})


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Per vector the ``prefix`` pivots of the smallest angle, nearest first; ties to the first pivot."""
    near = vectors @ pivots.T
    k = min(prefix, len(pivots))
    return np.argsort(-near, axis=1, kind="stable")[:, :k].astype(np.uint16)


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small numbers do not fit
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _pivots_of(dim: int, sample: dict[int, np.ndarray], n: int) -> np.ndarray:
    """The sampled pivots of a dimension; one that the sample misses gets fixed random directions."""
    if dim not in sample:
        sample[dim] = _unit(np.random.default_rng(dim).standard_normal((n, dim)))
    return sample[dim]


def _with_permutation(sample: dict[int, np.ndarray], pivots: int, prefix: int):
    def permuted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("vec").to_pylist()
            dims = np.array([len(b) // 8 for b in blobs], np.int64)
            out: list[bytes] = [b""] * len(blobs)
            for dim in np.unique(dims):
                of_dim = _pivots_of(int(dim), sample, pivots)
                own = np.flatnonzero(dims == dim)
                for part in np.array_split(own, math.ceil(len(own) / 2048)):
                    vectors = np.frombuffer(b"".join([blobs[i] for i in part])).reshape(len(part), dim)
                    for i, order in zip(part, nearest_pivots(_unit(vectors), of_dim, prefix), strict=True):
                        out[i] = order.tobytes()
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(columns | {"dim": pa.array(dims, pa.int32()), "perm": pa.array(out, pa.binary())})

    return permuted


class InvertedFiles:
    """Per pivot the rows that have it among their nearest, with its position there."""

    def __init__(self, permutations: np.ndarray):
        n, self.k = permutations.shape
        pivot = permutations.ravel()
        order = np.argsort(pivot, kind="stable")
        self.n = n
        self.rows = (order // self.k).astype(np.int32)
        self.positions = (order % self.k).astype(np.int32)
        self.starts = np.searchsorted(pivot[order], np.arange(int(pivot.max(initial=0)) + 2))

    def agreement(self, permutation: np.ndarray) -> np.ndarray:
        """Per row the sum of k - max(a, b) over shared pivots: k (k + 1) / 2 less half the footrule distance."""
        total = np.zeros(self.n, np.int32)
        for at, pivot in enumerate(permutation):
            if pivot + 1 < len(self.starts):
                own = slice(self.starts[pivot], self.starts[pivot + 1])
                total[self.rows[own]] += self.k - np.maximum(self.positions[own], at)
        return total


def _matrix(blobs: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1)


def _search(want: int, share: float, least: int, dense: float):
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        """For each query of the block: the ``want`` best of the block's ids."""
        out = {"query": [], "id": [], "score": [], "own": []}
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by("key")
            keys, ids = rows.column("key").to_pylist(), rows.column("ids").to_pylist()
            vectors = _matrix(rows.column("vec").to_pylist(), np.float64)
            files = InvertedFiles(_matrix(rows.column("perm").to_pylist(), np.uint16))
            take = min(len(keys), max(least, math.ceil(share * len(keys))))
            columns = (queries.column(c).to_pylist() for c in ("key", "vec", "perm"))
            for key, vec, perm in zip(*columns, strict=True):
                if take < len(keys):
                    agreement = files.agreement(np.frombuffer(perm, np.uint16))
                    edge = np.partition(agreement, len(keys) - take)[len(keys) - take]
                    near = np.flatnonzero(agreement >= min(edge, math.ceil((1 - dense) * files.k * (files.k + 1) / 2)))
                else:
                    near = np.arange(len(keys))
                scores = (vectors[near] * np.frombuffer(vec)).sum(axis=1)
                # Every vector has an id, so no more than ``want`` vectors and those tied with the last count.
                if len(near) > want:
                    edge = np.partition(scores, len(near) - want)[len(near) - want]
                    best = np.flatnonzero(scores >= edge)
                else:
                    best = np.arange(len(near))
                found = [(-scores[i], x["null"], x["id"] or 0, keys[near[i]] == key) for i in best for x in ids[near[i]]]
                for score, null, x, own in sorted(found)[:want]:
                    out["query"].append(key)
                    out["id"].append(None if null else x)
                    out["score"].append(-score)
                    out["own"].append(own)
        kinds = {"query": pa.binary(), "id": pa.int64(), "score": pa.float64(), "own": pa.bool_()}
        return pa.table(out, schema=pa.schema(kinds))

    return search


def _spread(vectors: np.ndarray, n: int, apart: float) -> np.ndarray:
    """Of unit vectors the first ``n`` that are not within ``apart`` (a cosine) of one taken before; then others, if these are fewer."""
    taken, refused = [], []
    for i, near in enumerate(vectors @ vectors.T > apart):
        (refused if near[taken].any() else taken).append(i)
        if len(taken) == n:
            break
    return vectors[(taken + refused)[:n]]


def _sampled_pivots(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """By dimension: ``n`` vectors of the ``SAMPLE`` times as many with the smallest hash, near copies last."""
    found = classes.select("vec", F.xxhash64("key").alias("hash")).orderBy("hash").limit(SAMPLE * n).collect()
    by_dim: dict[int, list[bytes]] = {}
    for row in found:
        by_dim.setdefault(len(row.vec) // 8, []).append(bytes(row.vec))
    return {dim: _spread(_unit(_matrix(blobs, np.float64)), n, APART) for dim, blobs in by_dim.items()}


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = SHARE,
    least: int = LEAST,
    dense: float = DENSE,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Per query its ``k`` nearest found by inner product: query_id, rank, id, score; ties to the smaller id.

    ``is_query`` is a condition on the id.  Vectors that are null, empty, zero,
    or hold null or non-finite numbers take no part.  Equal rows are one; rows
    of one id with different vectors are different rows, and each a query.  A
    query finds every other row of its own dimension, rows without id after
    those with one where scores are equal.  An empty table gives no rows.  Other
    columns are not read, so their names cannot clash.

    A third of all rows may be one vector: it is compared once, with the k + 1
    smallest ids that have it, as no other can be among anyone's k nearest.
    Blocks of at most ``least`` rows are searched in full.
    """
    if pivots > 1 << 16:
        raise ValueError("a permutation numbers its pivots with 16 bits")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = rows.mapInArrow(valid, "id long, vec binary").withColumn("key", F.unhex(F.md5("vec")))
    rows = written(rows, "valid")
    # Which ids of one vector can be answers: the k + 1 smallest, cut before and after the exchange.
    by_id = Window.partitionBy("key").orderBy(F.col("id").asc_nulls_last())
    first = rows.dropDuplicates(["key", "id"]).withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    entry = F.struct(F.col("id").isNull().alias("null"), "id")
    classes = first.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list(entry)).alias("ids"))
    classes = written(classes, "classes")
    queries = rows.where(F.col("id").isNotNull() & is_query).select("id", "key", "vec").dropDuplicates(["key", "id"])
    asked = queries.groupBy("key").agg(F.first("vec").alias("vec"))
    asked = written(asked, "asked")
    row_blocks = max(1, math.ceil(classes.count() / block_rows))
    query_blocks = max(1, math.ceil(asked.count() / block_queries))
    permuted = _with_permutation(_sampled_pivots(classes, pivots), pivots, prefix)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("key", F.lit(n)), F.lit(n)).cast("int")
    posted = classes.mapInArrow(permuted, "key binary, vec binary, ids array<struct<null: boolean, id: long>>, dim int, perm binary")
    posted = posted.withColumn("block", dealt(row_blocks)).withColumn("part", every(query_blocks))
    wanted = asked.mapInArrow(permuted, "key binary, vec binary, dim int, perm binary")
    wanted = wanted.withColumn("part", dealt(query_blocks)).withColumn("block", every(row_blocks))
    place = ("dim", "block", "part")
    found = posted.groupBy(*place).cogroup(wanted.groupBy(*place))
    found = found.applyInArrow(_search(k + 1, share, least, dense), "query binary, id long, score double, own boolean")
    order = (F.col("score").desc(), F.col("id").asc_nulls_last())
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("n") <= k + 1)
    best = written(best.drop("n"), "best")
    answers = queries.select(F.col("id").alias("query_id"), F.col("key").alias("query")).join(best, "query")
    answers = answers.where(~(F.col("own") & F.col("id").eqNullSafe(F.col("query_id"))))
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(*order))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
