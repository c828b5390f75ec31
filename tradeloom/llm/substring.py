"""Substring dedup: word windows repeated across documents, level by level.

The first level takes all windows of half ``min_words`` words.  Windows that
repeat across documents, and they alone, are extended to the next level: two
that overlap or touch make one of ``min_words``, then two of those one of twice
the length, until no window repeats.  So a window of ``min_words`` is looked at
only where all that the first level knows of it repeats, and that level decides
what is removed; the levels above tell how long the repeats are.

Every level is one exchange of fingerprints (see ``prints``): blocks of
documents in id order -> buckets of fingerprints -> blocks.  A bucket answers a
block only with the positions, in the block's own sorted list, of fingerprints
that other blocks have as well, and whether a block with smaller ids is among
them.  A longer window's fingerprint is made from those of its two parts, so
only the first level reads all texts; after it, texts without a candidate are
finished.  The first level only has to find candidates, so it sends the upper
bytes of its fingerprints: two that agree there and not below cost a candidate
that the next level, which compares whole ones, drops.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import BLOCK_BYTES, drop_shuffles, in_blocks, written
from tradeloom.llm.prints import MIX_A, MIX_B, bucket_starts, concat, mix, pack64, runs, unpack64, window_prints, word_prints

MIN_WORDS = 13
# Bytes of a fingerprint that the first level sends.
FIRST_BYTES = 6


class Block:
    """The words of one block's documents, in id order, and the prints of their windows."""

    def __init__(self, rows: pa.Table, width: int):
        ids = rows.column("id").to_numpy(zero_copy_only=False)
        known = ~np.asarray(rows.column("id").is_null())
        order = np.lexsort((np.where(known, ids, 0), known))
        self.rows = rows.take(pa.array(order))
        known = known[order]
        ids = self.rows.column("id")
        self.known = known
        # Rank of the id; equal ids are one document.
        values = np.asarray(ids.fill_null(0)).astype(np.int64)
        self.rank = np.cumsum(np.concatenate(([1], values[1:] != values[:-1])))[: len(values)]
        self.words = [(t or b"").split() for t in self.rows.column("text").cast(pa.binary()).to_pylist()]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        prints = concat([word_prints(w) for w in self.words], np.uint64)
        windows = window_prints(prints, width)
        doc = np.repeat(np.arange(len(self.words)), self.sizes)
        at = np.arange(len(windows))
        inside = (at + width <= self.ends[doc[: len(windows)]]) & known[doc[: len(windows)]]
        self.at = at[inside]  # first word of each window
        self.prints = windows[inside]
        self.doc = doc[self.at]


def upper(prints: np.ndarray, count: int) -> np.ndarray:
    """The upper ``count`` bytes of each print, the others 0."""
    return prints & ~np.uint64((1 << 8 * (8 - count)) - 1)


def _sent(block: int, prints: np.ndarray, buckets: int, count: int = 8) -> pa.Table:
    """A block's distinct prints, sorted, one row per bucket; only the upper ``count`` bytes travel."""
    prints = np.unique(upper(prints, count))
    starts = bucket_starts(prints, buckets)
    used = np.flatnonzero(np.diff(starts))
    return pa.table(
        {
            "bucket": pa.array(used, pa.int32()),
            "block": pa.array([block] * len(used), pa.int32()),
            "prints": pa.array([pack64(prints[starts[b] : starts[b + 1]], count) for b in used], pa.binary()),
        }
    )


SENT = "bucket int, block int, prints binary"


def _send(buckets: int, width: int, count: int):
    def send(rows: pa.Table) -> pa.Table:
        return _sent(rows.column("block")[0].as_py(), Block(rows, width).prints, buckets, count)

    return send


def _copies(rows: pa.Table, count: int = 8) -> pa.Table:
    """Of one bucket: for each block, which of its prints a smaller block has, too, and which only larger ones have."""
    block = np.asarray(rows.column("block"))
    bucket = rows.column("bucket")[0].as_py()
    blobs = rows.column("prints")
    order = np.argsort(block, kind="stable")
    lists = [unpack64(blobs[int(i)].as_py(), count) for i in order]
    sizes = [len(x) for x in lists]
    all_prints = concat(lists, np.uint64)
    owner = np.repeat(np.arange(len(lists)), sizes)
    offset = np.arange(len(all_prints)) - np.repeat(np.cumsum([0, *sizes[:-1]]) if sizes else [], sizes)
    by_print = np.argsort(all_prints, kind="stable")
    heads = runs(all_prints[by_print])
    first = np.zeros(len(all_prints), bool)
    first[by_print[heads]] = True
    lengths = np.diff(np.concatenate((heads, [len(by_print)])))

    def by_owner(chosen: np.ndarray) -> list[bytes]:
        chosen = chosen[np.argsort(owner[chosen] * np.int64(1 << 32) + offset[chosen])]
        cuts = np.searchsorted(owner[chosen], np.arange(len(lists) + 1))
        return [np.diff(offset[chosen[a:b]], prepend=0).astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]

    later, earliest = by_owner(by_print[~first[by_print]]), by_owner(by_print[heads[lengths > 1]])
    used = [i for i in range(len(lists)) if later[i] or earliest[i]]
    return pa.table(
        {
            "block": pa.array([int(block[order[i]]) for i in used], pa.int32()),
            "bucket": pa.array([bucket] * len(used), pa.int32()),
            "later": pa.array([later[i] for i in used], pa.binary()),
            "earliest": pa.array([earliest[i] for i in used], pa.binary()),
        }
    )


def _copies_of(count: int):
    return lambda rows: _copies(rows, count)


COPIES = "block int, bucket int, later binary, earliest binary"


def _judged(prints: np.ndarray, rank: np.ndarray, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of windows in document order: which a smaller document has, too, and which any other document has."""
    if not len(prints):
        return np.empty(0, bool), np.empty(0, bool)
    order = np.argsort(prints, kind="stable")
    sorted_prints, rank = prints[order], rank[order]
    heads = runs(sorted_prints)
    lengths = np.diff(np.concatenate((heads, [len(order)])))
    group = np.repeat(np.arange(len(heads)), lengths)
    starts = bucket_starts(sorted_prints[heads], buckets)
    smaller, others = np.zeros(len(heads), bool), rank[heads + lengths - 1] > rank[heads]
    columns = (answers.column(c).to_pylist() for c in ("bucket", "later", "earliest"))
    for bucket, later, earliest in zip(*columns, strict=True):
        for blob, flags in ((later, (smaller, others)), (earliest, (others,))):
            at = starts[bucket] + np.cumsum(np.frombuffer(blob, np.uint32).astype(np.int64))
            for flag in flags:
                flag[at] = True
    is_later, is_repeated = np.empty(len(order), bool), np.empty(len(order), bool)
    is_later[order] = smaller[group] | (rank > rank[heads][group])
    is_repeated[order] = others[group]
    return is_later, is_repeated


def _extended(place: np.ndarray, prints: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows made of a given one and the given one ``step`` words on; a place is document << 32 | first word, ascending."""
    if not len(place):
        return place, prints
    half = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
    whole = place[half] == place + step
    return place[whole], mix(prints[whole] * MIX_A + prints[half[whole]] * MIX_B)


def _packed(place: np.ndarray, prints: np.ndarray, docs: int) -> tuple[list[bytes], list[bytes]]:
    """Per document: its windows' first words, as differences, and their prints."""
    cuts = np.searchsorted(place >> 32, np.arange(docs + 1))
    word = place & 0xFFFFFFFF
    spots = [np.diff(word[a:b], prepend=0).astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
    return spots, [prints[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def _candidates(buckets: int, width: int, min_words: int, count: int):
    def candidates(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return FIRST.empty_table()
        block = Block(rows, width)
        _, repeated = _judged(upper(block.prints, count), block.rank[block.doc], answers, buckets)
        n = len(block.words)
        place = (block.doc.astype(np.int64) << 32) + block.at - (block.ends - block.sizes)[block.doc]
        spots, prints = _packed(*_extended(place[repeated], block.prints[repeated], min_words - width), n)
        left = [len(x) > 0 for x in prints]
        text = block.rows.column("text").combine_chunks()
        kept = [None if more else b" ".join(words) for more, words in zip(left, block.words, strict=True)]
        return pa.table(
            {
                "id": block.rows.column("id").combine_chunks().cast(pa.int64()),
                "n_words": pa.array(block.sizes, pa.int64()),
                "text": pc.if_else(pa.array(left), text, pa.scalar(None, text.type)),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                "block": pa.array([block.rows.column("block")[0].as_py()] * n, pa.int32()),
                "row": pa.array(np.arange(n), pa.int32()),
                "rank": pa.array(block.rank, pa.int32()),
                "spots": pa.array(spots, pa.binary()),
                "prints": pa.array(prints, pa.binary()),
            },
            FIRST,
        )

    return candidates


FIRST = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("text", pa.string()),
        ("kept_text", pa.string()),
        ("block", pa.int32()),
        ("row", pa.int32()),
        ("rank", pa.int32()),
        ("spots", pa.binary()),
        ("prints", pa.binary()),
    ]
)
FIRST_ROWS = "id long, n_words long, text string, kept_text string, block int, row int, rank int, spots binary, prints binary"


def _removed(words: list[bytes], first: np.ndarray, width: int) -> tuple[int, bytes, list[int]]:
    """Words covered by windows that begin at ``first``: how many, the text of the others, and starts and ends of the runs."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + width, -1)
    gone = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    return int(gone.sum()), b" ".join([words[i] for i in np.flatnonzero(~gone)]), edges.tolist()


def _decide(buckets: int, width: int):
    def decide(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return DECIDED.empty_table()
        own = Candidates(rows)
        n = len(own.rows)
        later, repeated = _judged(own.prints, np.asarray(own.rows.column("rank"))[own.doc], answers, buckets)
        cuts = np.searchsorted(own.doc[later], np.arange(n + 1))
        first = (own.place & 0xFFFFFFFF)[later]
        texts = own.rows.column("text").cast(pa.binary())
        found = [_removed(texts[i].as_py().split(), first[cuts[i] : cuts[i + 1]], width) for i in range(n)]
        removed, kept, spans = zip(*found, strict=True)
        spots, prints = _packed(*_extended(own.place[repeated], own.prints[repeated], width), n)
        columns = {c: own.rows.column(c) for c in ("id", "n_words", "block", "row", "rank")}
        columns |= {
            "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            "removed_spans": pa.array(spans, pa.list_(pa.int64())),
            "repeated": pa.array(np.bincount(own.doc[repeated], minlength=n) > 0),
            "spots": pa.array(spots, pa.binary()),
            "prints": pa.array(prints, pa.binary()),
        }
        return pa.table([columns[c] for c in DECIDED.names], DECIDED)

    return decide


STATE_ARROW = pa.schema(
    [("block", pa.int32()), ("row", pa.int32()), ("rank", pa.int32()), ("repeated", pa.bool_()), ("spots", pa.binary()), ("prints", pa.binary())]
)
STATE = "block int, row int, rank int, repeated boolean, spots binary, prints binary"
DECIDED = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_text", pa.string()),
        ("removed_spans", pa.list_(pa.int64())),
        *STATE_ARROW,
    ]
)
RESULT = f"id long, n_words long, n_removed long, kept_text string, removed_spans array<long>, {STATE}"


class Candidates:
    """The windows of one block that both their parts make possible repeats."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.take(pa.array(np.argsort(np.asarray(rows.column("row")), kind="stable")))
        spots = [np.cumsum(np.frombuffer(x, np.uint32).astype(np.int64)) for x in self.rows.column("spots").to_pylist()]
        self.doc = np.repeat(np.arange(len(spots)), [len(x) for x in spots])
        self.place = (self.doc.astype(np.int64) << 32) + concat(spots, np.int64)
        self.prints = concat([np.frombuffer(x, np.uint64) for x in self.rows.column("prints").to_pylist()], np.uint64)


def _send_candidates(buckets: int):
    def send(rows: pa.Table) -> pa.Table:
        return _sent(rows.column("block")[0].as_py(), Candidates(rows).prints, buckets)

    return send


def _next_level(buckets: int, width: int):
    def level(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return STATE_ARROW.empty_table()
        own = Candidates(rows)
        n = len(own.rows)
        _, repeated = _judged(own.prints, np.asarray(own.rows.column("rank"))[own.doc], answers, buckets)
        spots, prints = _packed(*_extended(own.place[repeated], own.prints[repeated], width), n)
        columns = {c: own.rows.column(c) for c in ("block", "row", "rank")}
        flags = pa.array(np.bincount(own.doc[repeated], minlength=n) > 0)
        return pa.table(columns | {"repeated": flags, "spots": pa.array(spots, pa.binary()), "prints": pa.array(prints, pa.binary())}, STATE_ARROW)

    return level


def longest_repeats(decided: DataFrame, buckets: int, width: int) -> DataFrame:
    """Per document (block, row) with a repeat: the longest doubling of ``width`` at which a window of it is repeated.

    Each level reads the candidates that the one before left, asks the buckets
    which of them repeat, and writes those that can be doubled once more.  Its
    exchange is only of use to itself, so the driver then has its files collected.
    """
    spark = decided.sparkSession
    reached, state = [], decided
    while True:
        reached.append(state.where("repeated").select("block", "row", F.lit(width).cast("long").alias("longest")))
        left = state.where("octet_length(prints) > 0").select("block", "row", "rank", "spots", "prints")
        if left.isEmpty():
            break
        width *= 2
        sent = left.groupBy("block").applyInArrow(_send_candidates(buckets), SENT)
        answers = sent.groupBy("bucket").applyInArrow(_copies_of(8), COPIES)
        state = left.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_next_level(buckets, width), STATE)
        state = written(state, f"repeats{width}")
        del left, sent, answers
        spark._jvm.System.gc()  # lets the context cleaner drop the shuffle files of finished levels
    return reduce(DataFrame.union, reached).groupBy("block", "row").agg(F.max("longest").alias("longest"))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    block_bytes: int = BLOCK_BYTES,
    kept: Callable[[Column], Column] | None = None,
    first_bytes: int = FIRST_BYTES,
) -> DataFrame:
    """Texts without the words of windows that start in a document with a smaller id.

    Words are runs of anything but ASCII white space.  One row per input row:
    id, n_words, n_removed, kept_text (kept words joined by one space),
    removed_spans (word starts and ends, alternating), and longest_repeat: the
    longest of min_words, 2 * min_words, 4 * min_words, ... of which the
    document has a window that another one has, too, or 0.  ``kept`` is applied
    to kept_text before it is stored, for instance a digest.  ``first_bytes``
    tells how much of a fingerprint the first level sends, not what is found.  Null texts have no
    words.  Rows of equal id are one document and do not remove from each
    other; rows without id neither lose nor claim a window.  Other columns of
    ``docs`` are not read, so their names cannot clash.
    """
    rows, n = in_blocks(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", block_bytes)
    half = -(-min_words // 2)
    sent = rows.groupBy("block").applyInArrow(_send(n, half, first_bytes), SENT)
    answers = sent.groupBy("bucket").applyInArrow(_copies_of(first_bytes), COPIES)
    first = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_candidates(n, half, min_words, first_bytes), FIRST_ROWS)
    store = kept if kept is not None else lambda text: text
    has_candidates = F.octet_length("prints") > 0
    first = first.withColumn("kept_text", F.when(~has_candidates, store(F.col("kept_text"))))
    first = written(first, "first_level")
    del rows, sent, answers
    drop_shuffles(docs.sparkSession)  # the shuffled texts are of no more use
    left = first.where(has_candidates).select("id", "n_words", "text", "block", "row", "rank", "spots", "prints")
    sent = left.groupBy("block").applyInArrow(_send_candidates(n), SENT)
    answers = sent.groupBy("bucket").applyInArrow(_copies_of(8), COPIES)
    decided = left.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_decide(n, min_words), RESULT)
    decided = written(decided.withColumn("kept_text", store(F.col("kept_text"))), "decided")
    del left, sent, answers
    longest = longest_repeats(decided, n, min_words)
    names = ["id", "n_words", "n_removed", "kept_text", "removed_spans"]
    none = F.lit(0).cast("long")
    finished = first.where(~has_candidates).select(
        "id", "n_words", none.alias("n_removed"), "kept_text", F.array().cast("array<long>").alias("removed_spans"), none.alias("longest_repeat")
    )
    found = decided.select("block", "row", *names).join(longest, ["block", "row"], "left")
    return finished.unionByName(found.select(*names, F.coalesce("longest", none).alias("longest_repeat")))
