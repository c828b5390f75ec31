"""Near-duplicates: consistent weighted samples of TF-IDF shingles, banded and verified.

1. Document frequencies of all five-word shingles, by the block exchange of
   ``prints``.  A shingle of one document cannot be shared, so all of them
   together count as one element with their summed weight: every weighted
   Jaccard similarity stays exactly the same, and only repeated shingles go on.
   A document whose repeated shingles carry less than the threshold's share of
   its weight has no partner at the threshold and ends here.
2. Improved consistent weighted sampling (Ioffe 2010) draws ``BANDS * ROWS``
   samples of each remaining document's weighted set.
3. Documents of equal sets are represented by their smallest id.  In each
   bucket of a band, all are compared with the smallest id.  Where a bucket
   still spans several classes, its members outside its main class are
   compared with all members of other classes, so that no link between two
   classes is missed; pairs inside one class need no comparison.
4. A pair is a link when its weighted Jaccard similarity, over all shingles, is
   at least the threshold.  Classes are the connected components.

Weights: tf * idf, with idf = 1 + IDF_SPAN * ln((N + 1) / (df + 1)) / ln(N + 1).
The span is small on purpose: what a large group of copies shares is frequent
for that very reason and must not weigh much less than the copies' edits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import BLOCK_BYTES, in_blocks, written
from tradeloom.llm.components import components
from tradeloom.llm.prints import (
    COUNTS,
    SENT,
    bucket_starts,
    concat,
    mix,
    multipliers,
    runs,
    send_counts,
    shared_counts,
    totals_of,
    window_prints,
    word_prints,
)

SHINGLE = 5
THRESHOLD = 0.8
IDF_SPAN = 0.25
# Samples times shingles that are drawn at once.
CELLS = 1 << 16
BANDS, ROWS = 16, 4
#: Lower-cases A-Z and turns every other ASCII character but digits and letters into a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


class Shingles:
    """The distinct shingles of a block: print, document and frequency, sorted by print."""

    def __init__(self, texts: list, width: int):
        words = [(t or b"").translate(FOLD).split() for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        prints = concat([word_prints(w) for w in words], np.uint64)
        windows = window_prints(prints, width)
        doc = np.repeat(np.arange(len(words)), sizes)
        at = np.arange(len(windows))
        inside = at + width <= ends[doc[: len(windows)]]
        short = np.flatnonzero((sizes > 0) & (sizes < width))
        # A text of fewer words is one shingle.
        own = np.array([xxhash.xxh64_intdigest(b" ".join(words[i]), seed=7) for i in short], np.uint64)
        values = np.concatenate((windows[inside], own))
        owner = np.concatenate((doc[: len(windows)][inside], short)).astype(np.int64)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        if len(short):
            order = np.lexsort((owner, values))
            values, owner = values[order], owner[order]
        head = np.ones(len(values), bool)
        head[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(head)
        self.tf = np.diff(np.concatenate((starts, [len(values)])))
        self.prints, self.doc = values[starts], owner[starts]
        self.heads = runs(self.prints)  # first entry of each distinct print
        self.df = np.diff(np.concatenate((self.heads, [len(self.prints)])))  # documents of this block


def _send(buckets: int, width: int):
    def send(rows: pa.Table) -> pa.Table:
        found = Shingles(rows.column("text").cast(pa.binary()).to_pylist(), width)
        return send_counts(rows.column("block")[0].as_py(), found.prints[found.heads], found.df, buckets)

    return send


def weighted_samples(prints: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """Improved consistent weighted sampling: for each of ``samples``, a print of the drawn (element, level).

    Two sets draw the same with probability of their weighted Jaccard similarity.
    """
    seeds = multipliers(3 * samples, 11).reshape(3, samples)
    log_weight = np.log(weights).astype(np.float32)
    out = np.empty(samples, np.uint64)
    scale, half, tiny = np.float32(2.0**-32), np.float32(0.5), np.float32(1e-30)

    def uniforms(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(prints ^ seed[:, None]).view(np.uint32).reshape(len(seed), -1, 2)
        return (h[..., 0].astype(np.float32) + half) * scale, (h[..., 1].astype(np.float32) + half) * scale

    step = max(1, CELLS // len(prints))
    for start in range(0, samples, step):
        own = seeds[:, start : start + step]
        u1, u2 = uniforms(own[0])
        r = np.maximum(-np.log(u1 * u2), tiny)  # Gamma(2, 1), as is c
        u1, u2 = uniforms(own[1])
        c = np.maximum(-np.log(u1 * u2), tiny)
        beta = uniforms(own[2])[0]
        level = np.floor(log_weight / r + beta)
        rank = np.log(c) - r * (level - beta + np.float32(1))
        drawn = np.argmin(rank, axis=1)
        levels = level[np.arange(len(drawn)), drawn].astype(np.int64).view(np.uint64)
        out[start : start + step] = prints[drawn] ^ mix(levels)
    return mix(out)


def band_keys(prints: np.ndarray, weights: np.ndarray, alone: float, digest: bytes) -> list[int]:
    """The keys of a set in all bands; what only this document has is one element of weight ``alone``."""
    if alone:
        prints = np.append(prints, np.uint64(xxhash.xxh64_intdigest(digest)))
        weights = np.append(weights, np.float32(alone))
    drawn = weighted_samples(prints, weights, BANDS * ROWS).reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for m, column in zip(multipliers(ROWS, 3), drawn.T, strict=True):
        keys += column * m
    return mix(keys).view(np.int64).tolist()


def _draw(batches):
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("prints", "weights", "total", "shared", "digest"))
        keys = [
            band_keys(np.frombuffer(p, np.uint64), np.frombuffer(w, np.float32), total - shared, digest)
            for p, w, total, shared, digest in zip(*columns, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=[*batch.schema.names, "bands"])


def _sets(buckets: int, width: int, n_docs: int, threshold: float):
    scale = np.log(n_docs + 1.0) or 1.0

    def sets(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = {name: [] for name in SETS_ARROW.names}
        if rows.num_rows:
            found = Shingles(rows.column("text").cast(pa.binary()).to_pylist(), width)
            starts = bucket_starts(found.prints[found.heads], buckets)
            df = np.repeat(totals_of(answers, starts, found.df), found.df)
            weight = (found.tf * (1 + IDF_SPAN * np.log((n_docs + 1.0) / (df + 1.0)) / scale)).astype(np.float32)
            repeated = df > 1
            n = rows.num_rows
            total = np.bincount(found.doc, weight, n)
            shared = np.bincount(found.doc, weight * repeated, n)
            going = (shared >= (threshold - 1e-6) * total) & (total > 0)
            keep = np.flatnonzero(repeated & going[found.doc])
            keep = keep[np.argsort(found.doc[keep], kind="stable")]  # by document, prints stay sorted
            ends = np.searchsorted(found.doc[keep], np.arange(n + 1))
            ids = rows.column("id").to_pylist()
            for i in np.flatnonzero(going):
                own = keep[ends[i] : ends[i + 1]]
                prints, weights = found.prints[own], weight[own]
                alone = total[i] - float(weights.sum(dtype=np.float64))
                if alone < 1e-4 * total[i]:
                    alone = 0.0
                state = xxhash.xxh3_128(prints.tobytes())
                state.update(weights.tobytes())
                if alone:  # what only this document has
                    state.update(b"%d" % ids[i])
                out["id"].append(ids[i])
                out["digest"].append(state.digest())
                out["total"].append(float(total[i]))
                out["shared"].append(float(total[i]) - alone)
                out["prints"].append(prints.tobytes())
                out["weights"].append(weights.tobytes())
        return pa.table(out, schema=SETS_ARROW)

    return sets


SETS = "id long, digest binary, total double, shared double, prints binary, weights binary"
SETS_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("digest", pa.binary()),
        ("total", pa.float64()),
        ("shared", pa.float64()),
        ("prints", pa.binary()),
        ("weights", pa.binary()),
    ]
)


def _similar(threshold: float):
    def similar(batches):
        for batch in batches:
            a, b, keep = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            columns = (batch.column(c).to_pylist() for c in ("pa", "wa", "ta", "pb", "wb", "tb"))
            for pa_, wa, ta, pb, wb, tb in zip(*columns, strict=True):
                x, y = np.frombuffer(pa_, np.uint64), np.frombuffer(pb, np.uint64)
                _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                both = np.minimum(np.frombuffer(wa, np.float32)[i], np.frombuffer(wb, np.float32)[j]).sum(dtype=np.float64)
                keep.append(both >= (threshold - 1e-6) * (ta + tb - both))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(keep, pa.bool_())})

    return similar


def _possible(x: str, y: str, threshold: float):
    """Whether two sets can reach the threshold, from their totals and repeated weights alone.

    They share at most the smaller repeated weight r, so their similarity is
    at most r / (total_x + total_y - r).
    """
    most = F.least(f"shared_{x}", f"shared_{y}")
    return most * (1 + threshold) >= (threshold - 1e-6) * (F.col(f"total_{x}") + F.col(f"total_{y}"))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked) for pairs (a, b)."""
    full = pairs.select("a", "b").join(
        sets.select(F.col("id").alias("b"), F.col("prints").alias("pb"), F.col("weights").alias("wb"), F.col("total").alias("tb")), "b"
    ).join(sets.select(F.col("id").alias("a"), F.col("prints").alias("pa"), F.col("weights").alias("wa"), F.col("total").alias("ta")), "a")
    columns = full.select("a", "b", "pa", "wa", "ta", "pb", "wb", "tb")
    return columns.mapInArrow(_similar(threshold), "a long, b long, linked boolean")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, class_id) for every id: the smallest id of its class of near-duplicates.

    Words are runs of ASCII letters and digits and all non-ASCII characters,
    A-Z lower-cased.  Texts of fewer than ``shingle`` words are one shingle;
    null and wordless texts are alone in their class.  Repeated rows of an id
    give one row (of differing texts, that of the smallest set digest counts).
    Rows without id get a null class.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = rows.where(F.col("id").isNotNull())
    n_docs = known.count()
    blocks, n = in_blocks(known, "id", block_bytes)
    sent = blocks.groupBy("block").applyInArrow(_send(n, shingle), SENT)
    counted = sent.groupBy("bucket").applyInArrow(shared_counts, COUNTS)
    found = blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_sets(n, shingle, n_docs, threshold), SETS)
    sets = written(found, "sets")

    ids = rows.select("id").distinct()
    copies = written(
        sets.groupBy("id").agg(F.min("digest").alias("digest")).groupBy("digest").agg(F.min("id").alias("rep")), "copies"
    )
    member = sets.select("id", "digest").join(copies, "digest").groupBy("id").agg(F.min("rep").alias("rep"))
    heads = sets.join(copies.select(F.col("rep").alias("id"), "digest"), ["id", "digest"]).dropDuplicates(["id"])
    heads = written(heads.mapInArrow(_draw, f"{SETS}, bands array<long>"), "heads")
    bands = heads.select("id", "total", "shared", F.explode("bands").alias("key"))
    least = F.min(F.struct(F.col("id"), F.col("total"), F.col("shared"))).alias("hub")
    buckets = bands.groupBy("key").agg(least, F.min("total").alias("least_total"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(buckets.select("key", "least_total", F.col("hub.id").alias("a"), F.col("hub.total").alias("total_a"), F.col("hub.shared").alias("shared_a")), "buckets")
    own = F.col("id").alias("b"), F.col("total").alias("total_b"), F.col("shared").alias("shared_b")
    in_bucket = written(bands.join(buckets, "key").select("key", "least_total", "a", "total_a", "shared_a", *own), "in_bucket")
    stars = in_bucket.where(F.col("a") != F.col("b")).where(_possible("a", "b", threshold)).select("a", "b").distinct()
    first = written(_verified(stars, heads, threshold), "stars")
    links = first.where("linked").select("a", "b")
    classes = components(links)

    # Buckets that still span several classes.
    columns = "key", "b", "total_b", "shared_b", "least_total", F.coalesce("class_id", "b").alias("class")
    classed = written(in_bucket.join(classes.withColumnRenamed("id", "b"), "b", "left").select(*columns), "classed")
    per_class = classed.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
    main = per_class.groupBy("key").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count(F.lit(1)).alias("classes"))
    main = written(main.where("classes > 1").select("key", "main"), "main")
    # A stray that could reach the threshold with no member of the bucket, not even the lightest, has no pair.
    alive = F.col("shared_b") * (1 + threshold) >= (threshold - 1e-6) * (F.col("total_b") + F.col("least_total"))
    open_buckets = classed.where(alive).join(main, "key")
    # With all keys of a member at hand, a pair is made only in the first bucket that both are in.
    open_buckets = written(open_buckets.join(heads.select(F.col("id").alias("b"), "bands"), "b"), "open")
    strays = open_buckets.where("class <> main").select("key", *[F.col(f"{c}_b").alias(f"{c}_x") for c in ("total", "shared")], F.col("b").alias("x"), F.col("class").alias("class_x"), F.col("bands").alias("bands_x"))
    others = open_buckets.select("key", *[F.col(f"{c}_b").alias(f"{c}_y") for c in ("total", "shared")], F.col("b").alias("y"), F.col("class").alias("class_y"), F.col("bands").alias("bands_y"), (F.col("class") == F.col("main")).alias("in_main"))
    allowed = (F.col("class_x") != F.col("class_y")) & (F.col("in_main") | (F.col("x") < F.col("y"))) & _possible("x", "y", threshold)
    crossing = (
        strays.withColumnRenamed("key", "key_x")
        .join(others, (F.col("key_x") == F.col("key")) & allowed & (F.array_intersect("bands_x", "bands_y")[0] == F.col("key")))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
        .join(first.select("a", "b"), ["a", "b"], "left_anti")
    )
    second = written(_verified(crossing, heads, threshold), "crossing").where("linked").select("a", "b")
    final = components(links.union(second))
    return (
        ids.join(member, "id", "left")
        .join(final.select(F.col("id").alias("rep"), "class_id"), "rep", "left")
        .select("id", F.coalesce("class_id", "rep", "id").alias("class_id"))
    )
