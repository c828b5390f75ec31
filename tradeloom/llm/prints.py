"""64-bit fingerprints of words and windows, and their compact exchange between blocks and buckets.

A block of documents sends each distinct fingerprint once, packed with its
neighbours into one binary per bucket; so a fingerprint that a third of all
documents share reaches its bucket once per block, not once per document, and
the shuffle carries about seven bytes a fingerprint instead of a row.
Equal words always have equal fingerprints; of n different ones, about
n * n / 2**65 pairs are taken for equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    h = (h ^ (h >> SHIFT)) * MIX_A
    h = (h ^ (h >> SHIFT)) * MIX_B
    return h ^ (h >> SHIFT)


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants, fixed by the seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_prints(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_prints(h: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Fingerprints of all runs of ``width`` word fingerprints, also those across documents."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, m in enumerate(multipliers(width, seed)):
        total += h[i : i + n] * m
    return mix(total)


def bucket_starts(sorted_prints: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins: buckets are equal ranges of the upper 32 bits."""
    index = ((sorted_prints >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(index, np.arange(buckets + 1, dtype=np.uint64))


def pack64(a: np.ndarray, count: int = 8) -> bytes:
    """Byte planes, highest first, the upper ``count``: sorted values then compress well in the shuffle."""
    return np.ascontiguousarray(a.astype(">u8").view(np.uint8).reshape(-1, 8).T[:count]).tobytes()


def unpack64(blob: bytes, count: int = 8) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(count, -1)
    if count < 8:
        planes = np.vstack([planes, np.zeros((8 - count, planes.shape[1]), np.uint8)])
    return np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64)


def concat(arrays: list, dtype) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


SENT = "bucket int, block int, prints binary, counts binary"


def send_counts(block: int, distinct: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """A block's distinct fingerprints, sorted, and their counts (or several rows of counts): one row per bucket."""
    starts = bucket_starts(distinct, buckets)
    used = np.flatnonzero(np.diff(starts))
    counts = counts.astype(np.uint64)
    return pa.table(
        {
            "bucket": pa.array(used, pa.int32()),
            "block": pa.array([block] * len(used), pa.int32()),
            "prints": pa.array([pack64(distinct[starts[b] : starts[b + 1]]) for b in used], pa.binary()),
            "counts": pa.array([pack64(counts[..., starts[b] : starts[b + 1]].ravel()) for b in used], pa.binary()),
        }
    )


def shared_counts(rows: pa.Table) -> pa.Table:
    """Of one bucket: for each block, the total count of those of its prints that other blocks have, too."""
    return _totals(rows, False)


def owned_counts(rows: pa.Table) -> pa.Table:
    """As ``shared_counts``, each total doubled; 1 more for the first block that counts the print, its owner."""
    return _totals(rows, True)


def _totals(rows: pa.Table, owners: bool) -> pa.Table:
    bucket = rows.column("bucket")[0].as_py()
    rows = rows.take(pa.array(np.argsort(np.asarray(rows.column("block")), kind="stable")))
    block = np.asarray(rows.column("block"))
    lists = [unpack64(x) for x in rows.column("prints").to_pylist()]
    counts = [unpack64(x).reshape(-1, len(own)) for x, own in zip(rows.column("counts").to_pylist(), lists, strict=True)]
    counts = np.concatenate(counts, axis=1)
    sizes = np.array([len(x) for x in lists], np.int64)
    prints = concat(lists, np.uint64)
    ends = np.cumsum(sizes)
    order = np.argsort(prints, kind="stable")
    heads = runs(prints[order])
    lengths = np.diff(np.concatenate((heads, [len(prints)])))
    totals = np.empty_like(counts)
    totals[:, order] = np.repeat(np.add.reduceat(counts[:, order], heads, axis=1), lengths, axis=1)
    if owners:
        positive = (counts[0, order] > 0).astype(np.int64)
        rank = np.cumsum(positive)
        first = (positive > 0) & (rank - np.repeat(rank[heads] - positive[heads], lengths) == 1)
        totals *= np.uint64(2)
        totals[0, order] += first.astype(np.uint64)
    shared = np.zeros(len(prints), bool)
    shared[order] = np.repeat(lengths > 1, lengths)
    out = {"block": [], "bucket": [], "at": [], "total": []}
    for i, (size, end) in enumerate(zip(sizes, ends, strict=True)):
        at = np.flatnonzero(shared[end - size : end])
        if len(at):
            out["block"].append(int(block[i]))
            out["bucket"].append(bucket)
            out["at"].append(np.diff(at, prepend=0).astype(np.uint32).tobytes())
            out["total"].append(pack64(totals[:, end - size + at].ravel()))
    kinds = {"block": pa.int32(), "bucket": pa.int32(), "at": pa.binary(), "total": pa.binary()}
    return pa.table(out, schema=pa.schema(kinds))


COUNTS = "block int, bucket int, at binary, total binary"


def totals_of(answers: pa.Table, starts: np.ndarray, local: np.ndarray) -> np.ndarray:
    """The block's own counts (one row or several), replaced by the totals that the buckets answered."""
    totals = local.astype(np.uint64)
    columns = (answers.column(c).to_pylist() for c in ("bucket", "at", "total"))
    for bucket, at, total in zip(*columns, strict=True):
        places = starts[bucket] + np.cumsum(np.frombuffer(at, np.uint32).astype(np.int64))
        totals[..., places] = unpack64(total).reshape(*totals.shape[:-1], -1)
    return totals
