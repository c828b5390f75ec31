"""LM scoring: prediction by partial matching over bytes, and a smoothed unigram base.

The trie holds the byte contexts of length 0 to ``ORDER`` and how often each
byte followed.  A byte is predicted from the longest context: with escape
method C, a context with t observations of d different bytes gives a seen byte
c / (t + d) and leaves d / (t + d) to the next shorter context, in which the
bytes already refused are excluded; below order 0 the rest is uniform.

``pretrained`` learns one trie from all training texts.  It is never whole in
one place: a gram is a context and the byte after it, and each block of
documents asks buckets about the grams it has.

1. Context lengths above ``SPLIT``: a bucket holds all grams of the nearest
   ``SPLIT`` bytes that hash to it, and answers each with its probability, or
   with what is left to the shorter contexts.
2. The shorter ones, whose grams are few but each in many blocks, go through
   the block exchange of ``prints`` twice.  First come the count of every gram
   and which block owns it: the first that learns it.  Then per context its
   observations t, its different bytes d, and x, what these bytes count in the
   next shorter context; d and x are sums over grams, to which each gram's owner
   adds once.

What a shorter context has left after exclusion is t - x of d - d' bytes, x and
d' being those of the longer one, so bytes are predicted from sums alone.
``adaptive`` starts every document with an empty trie that learns as it
predicts.

The base needs the corpus count of every token of every document.  They come
by the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import BLOCK_BYTES, in_any_blocks
from tradeloom.llm.prints import (
    COUNTS,
    SENT,
    bucket_starts,
    concat,
    mix,
    owned_counts,
    pack64,
    runs,
    send_counts,
    shared_counts,
    totals_of,
    unpack64,
    word_prints,
)

ORDER = 6
SYMBOLS = 256
# Bits of a context byte in a gram: 0 is none, before the text; others are the byte + 1.
CODE = 9
CODES = (1 << CODE) - 1
# A gram of the longest context is one 64-bit integer, so prints of grams are exact.
LONGEST = (62 - 8) // CODE
# Longer contexts are answered where their nearest bytes are at home.
SPLIT = 4
# Bytes that are looked at together, so that their arrays stay near the processor; longer texts are taken piece by piece.
PIECE = 1 << 20
#: Lower-cases A-Z.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class ByteTrie:
    """A trie of byte contexts, at most ``order`` long, that predicts and learns byte by byte."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.counts: dict[bytes, dict[int, int]] = {}

    def learn(self, text: bytes, at: int) -> None:
        for n in range(min(self.order, at) + 1):
            node = self.counts.setdefault(text[at - n : at], {})
            node[text[at]] = node.get(text[at], 0) + 1

    def probability(self, text: bytes, at: int) -> float:
        share, excluded, symbol = 1.0, set(), text[at]
        for n in range(min(self.order, at), -1, -1):
            seen = {s: c for s, c in self.counts.get(text[at - n : at], {}).items() if s not in excluded}
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if len(excluded) + kinds == SYMBOLS:  # nothing is left to escape to
                kinds = 0
            if symbol in seen:
                return share * seen[symbol] / (total + kinds)
            share *= kinds / (total + kinds)
            excluded |= seen.keys()
        return share / (SYMBOLS - len(excluded))

    def log10(self, text: bytes, adaptive: bool) -> float:
        total = 0.0
        for at in range(len(text)):
            total += np.log10(self.probability(text, at))
            if adaptive:
                self.learn(text, at)
        return float(total)


def _pieces(texts: list[bytes], order: int):
    """(bytes, position of each byte in its text, which bytes count, text of each byte), piece by piece.

    A piece has whole texts, or part of a long one after the ``order`` bytes before it.
    """
    parts, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), PIECE):
            before = min(order, start)
            part = text[start - before : start + PIECE]
            if size + len(part) > PIECE and parts:
                yield _piece(parts)
                parts, size = [], 0
            parts.append((part, start - before, before, i))
            size += len(part)
    if parts:
        yield _piece(parts)


def _piece(parts: list[tuple[bytes, int, int, int]]):
    data = np.frombuffer(b"".join(p[0] for p in parts), np.uint8).astype(np.int64)
    sizes = np.array([len(p[0]) for p in parts])
    own = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = own + np.repeat([p[1] for p in parts], sizes)
    return data, at, own >= np.repeat([p[2] for p in parts], sizes), np.repeat([p[3] for p in parts], sizes)


def _keys(data: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The gram of each byte: its context, the nearest byte highest, and the byte itself lowest."""
    key, codes = data.copy(), data + 1
    for n in range(1, min(order, len(data) - 1) + 1):
        key[n:] |= codes[:-n] << (8 + CODE * (order - n))
    # The first bytes of a text have less before them.
    early = np.flatnonzero(at < order)
    nearest = [SYMBOLS - 1 | ((1 << CODE * n) - 1) << (8 + CODE * (order - n)) for n in range(order + 1)]
    key[early] &= np.array(nearest, np.int64)[at[early]]
    return key


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    heads = runs(keys)
    return keys[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts[:0]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct ones of lists of distinct sorted keys, the sums of their counts, and where each list's keys are among them."""
    every = np.sort(concat(keys, np.int64))
    every = every[runs(every)]
    sums, places = np.zeros(len(every), np.int64), []
    for own, times in zip(keys, counts, strict=True):
        at = np.searchsorted(every, own)
        sums[at] += times
        places.append(at.astype(np.int32))
    return every, sums, places


def count_contexts(texts: list[bytes], order: int = ORDER, training: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct grams of all bytes, sorted, and how often training texts have each; contexts stay inside a text."""
    training = np.ones(len(texts), np.int64) if training is None else training.astype(np.int64)
    keys, counts = [], []
    for data, at, own, doc in _pieces(texts, order):
        marked = (_keys(data, at, order) << 1 | training[doc])[own]
        marked.sort()
        heads = runs(marked >> 1)
        keys.append(marked[heads] >> 1)
        counts.append(np.add.reduceat(marked & 1, heads))
    return list(_merged(keys, counts)[:2])


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place of each key among them: sorted by the lower half, then by the upper."""
    low, rank = (1 << 32) - 1, np.arange(len(keys))
    half = (keys & (1 << 31) - 1) << 32 | rank
    half.sort()
    order = half & low
    half = (keys >> 31)[order] << 32 | rank
    half.sort()
    order = order[half & low]
    keys = keys[order]
    heads = runs(keys)
    new, place = np.zeros(len(keys), np.int32), np.empty(len(keys), np.int32)
    new[heads[1:]] = 1
    place[order] = np.cumsum(new)
    return keys[heads], place


def place_contexts(texts: list[bytes], order: int, training: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """As ``count_contexts``; besides, per piece, the place of each byte's gram among them, and the byte's text."""
    keys, counts, spots = [], [], []
    for data, at, own, doc in _pieces(texts, order):
        distinct, spot = _grouped(_keys(data, at, order)[own])
        doc = doc[own]
        keys.append(distinct)
        counts.append(np.bincount(spot, training[doc], len(distinct)).astype(np.int64))
        spots.append((spot, doc.astype(np.int32)))
    every, sums, places = _merged(keys, counts)
    return every, sums, [(place[spot], doc) for place, (spot, doc) in zip(places, spots, strict=True)]


#: Per key: its probability if found, else the share left to shorter contexts; whether found; x << 16 | d of the last context.
State = tuple[np.ndarray, np.ndarray, np.ndarray]


class Grams:
    """Grams of some context lengths that the distinct ``keys``, those of ``order``, imply.

    A context of n bytes has n codes above 0, so longer ones are larger
    numbers, and the sorted grams are in order of length and context.
    ``longest`` has what ``keys`` imply at the longest of the lengths, also
    where a text has less before it, and the counts.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, lengths: range):
        self.keys, self.order, self.lengths = keys, order, lengths
        grams, sums = [], []
        for n in range(order, lengths.start - 1, -1):
            if n < order:
                keys, counts = _summed((keys >> (8 + CODE)) << 8 | keys & 255, counts)
            if n == lengths.stop - 1:
                self.longest = keys, counts
            if n in lengths:
                valid = (keys >> 8) & CODES > 0 if n else slice(None)
                grams.insert(0, keys[valid])
                sums.insert(0, counts[valid])
        self.grams, self.counts = np.concatenate(grams), np.concatenate(sums)
        self.heads = runs(self.grams >> 8)
        self.contexts = self.grams[self.heads] >> 8

    def of_length(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per key: the gram of n context bytes, and whether the text has that many before it."""
        context = self.keys >> (8 + CODE * (self.order - n))
        return context << 8 | self.keys & 255, context & CODES > 0 if n else np.ones(len(self.keys), bool)

    def local_stats(self, totals: np.ndarray, owned: np.ndarray) -> np.ndarray:
        """Per context: the observations here; and x << 16 | d over the grams owned here."""
        if not len(self.heads):
            return np.empty((2, 0), np.int64)
        shorter = np.searchsorted(self.grams, (self.grams >> (8 + CODE)) << 8 | self.grams & 255)
        x = np.where(self.grams >> 8 > 0, totals[shorter], 0)
        return np.add.reduceat(np.stack([self.counts, owned * (x << 16 | 1)]), self.heads, axis=1)

    def predict(self, totals: np.ndarray, stats: np.ndarray, lengths: range, state: State | None = None) -> State:
        """Escape down the lengths, from the totals by gram and by context."""
        n_keys = len(self.keys)
        sizes = np.diff(np.concatenate((self.heads, [len(self.grams)])))
        context_of = np.repeat(np.arange(len(self.heads)), sizes)
        p, found, left = state or (np.ones(n_keys), np.zeros(n_keys, bool), np.zeros(n_keys, np.int64))
        if not len(self.grams):
            return p, found, left
        shorter = np.minimum(np.searchsorted(self.grams, (self.grams >> (8 + CODE)) << 8 | self.grams & 255), len(self.grams) - 1)
        at, long_enough = np.zeros(n_keys, np.int64), np.zeros(n_keys, bool)
        for n in reversed(lengths):
            gram, valid = self.of_length(n)
            at = np.where(long_enough, shorter[at], at)
            new = np.flatnonzero(valid & ~long_enough)  # all of them first, then those at the start of texts
            at[new] = np.minimum(np.searchsorted(self.grams, gram[new]), len(self.grams) - 1)
            long_enough = valid
            valid = valid & (self.grams[at] == gram)
            context = context_of[at]
            refused, own = np.where(valid, stats[1, context], 0), left
            total = np.where(valid, stats[0, context], 0) - (own >> 16)
            seen = refused & 0xFFFF
            kinds = np.where(seen < SYMBOLS, seen - (own & 0xFFFF), 0)  # or nothing is left to escape to
            count = np.where(valid, totals[at], 0)
            is_open = ~found & (total > 0)
            hit = is_open & (count > 0)
            p = np.where(is_open, p * np.where(hit, count, kinds) / np.maximum(total + kinds, 1), p)
            found, left = found | hit, refused
        return p, found, left


def _log10(state: State) -> np.ndarray:
    p, found, left = state
    return np.log10(np.where(found, p, p / np.maximum(SYMBOLS - (left & 0xFFFF), 1)))


def log_tables(counts: list[np.ndarray], order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of a small corpus in one place, per context length: the contexts seen, and log10 P(byte | context) by row."""
    keys, times = counts
    learnt = Grams(keys, times, order, range(order + 1))
    seen = learnt.contexts[np.add.reduceat(learnt.counts, learnt.heads) > 0]
    tables = []
    for n in range(order + 1):
        own = seen[(seen >= 1 << CODE * (n - 1)) & (seen < 1 << CODE * n)] if n else seen[seen == 0]
        asked = ((own << (8 + CODE * (order - n)))[:, None] | np.arange(SYMBOLS)).ravel()
        every, group = np.unique(np.concatenate((keys, asked)), return_inverse=True)
        times_of = np.bincount(group[: len(keys)], times, len(every)).astype(np.int64)
        grams = Grams(every, times_of, order, range(order + 1))
        logs = _log10(grams.predict(grams.counts, grams.local_stats(grams.counts, grams.counts > 0), grams.lengths))
        tables.append((own, logs[group[len(keys) :]].reshape(-1, SYMBOLS)))
    return tables


def score(spots: list, logs: np.ndarray, n_texts: int) -> np.ndarray:
    """log10 probability of each text from those of its distinct grams."""
    total = np.zeros(n_texts)
    for spot, doc in spots:
        total += np.bincount(doc, logs[spot], n_texts)
    return total


def _texts(rows: pa.Table) -> tuple[list[bytes], np.ndarray]:
    return [(t or b"").translate(LOWER) for t in rows.column("text").cast(pa.binary()).to_pylist()], np.asarray(rows.column("training"))


def _dealt(prints: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of prints by bucket, theirs within one, and how many each bucket has; 16-bit numbers are sorted by digits."""
    bucket = (mix(prints) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    return np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=buckets)


def _homes(keys: np.ndarray, order: int, buckets: int) -> list[np.ndarray]:
    """Per bucket: the keys whose nearest ``SPLIT`` bytes are at home there, in order."""
    dealt, sizes = _dealt((keys >> (8 + CODE * (order - SPLIT))).astype(np.uint64), buckets)
    return np.split(dealt, np.cumsum(sizes)[:-1])


def _squeezed(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes, after their number."""
    return len(a).to_bytes(8) + (pa.compress(pack64(a), "zstd", asbytes=True) if len(a) else b"")


def _unsqueezed(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8])
    return unpack64(pa.decompress(blob[8:], 8 * n, "zstd", asbytes=True)).astype(np.int64) if n else np.empty(0, np.int64)


def _send_keys(block: int, keys: np.ndarray, counts: np.ndarray, order: int, buckets: int) -> pa.Table:
    homes = [(b, own) for b, own in enumerate(_homes(keys, order, buckets)) if len(own)]
    return pa.table(
        {
            "bucket": pa.array([b for b, _ in homes], pa.int32()),
            "block": pa.array([block] * len(homes), pa.int32()),
            "prints": pa.array([_squeezed(np.diff(keys[own], prepend=0)) for _, own in homes], pa.binary()),
            "counts": pa.array([_squeezed(counts[own]) for _, own in homes], pa.binary()),
        }
    )


def _predict_keys(order: int):
    def predict(rows: pa.Table) -> pa.Table:
        """For each block its keys' states: which distinct probability each has; these, then x and d of keys not found.

        Probabilities are 32-bit floats, negative where they are shares of keys not found.
        """
        lists = [np.cumsum(_unsqueezed(x)) for x in rows.column("prints").to_pylist()]
        keys, totals, places = _merged(lists, [_unsqueezed(x) for x in rows.column("counts").to_pylist()])
        grams = Grams(keys, totals, order, range(SPLIT, order + 1))
        stats = grams.local_stats(grams.counts, grams.counts > 0)
        p, found, left = grams.predict(grams.counts, stats, range(SPLIT + 1, order + 1))
        values, code = np.unique(np.where(found, p, -p).astype(np.float32).view(np.uint32), return_inverse=True)
        own_codes, own_values = [], []
        for at in places:
            used, own_code, times = np.unique(code[at], return_inverse=True, return_counts=True)
            by_times = np.argsort(-times, kind="stable")  # small codes for frequent ones
            own_codes.append(_squeezed(np.argsort(by_times)[own_code]))
            own_values.append(_squeezed(np.concatenate((values[used[by_times]], left[at[~found[at]]]))))
        return pa.table(
            {
                "block": rows.column("block"),
                "bucket": rows.column("bucket"),
                "at": pa.array(own_codes, pa.binary()),
                "total": pa.array(own_values, pa.binary()),
            }
        )

    return predict


def _states(answers: pa.Table, keys: np.ndarray, order: int, buckets: int) -> State:
    p, left = np.ones(len(keys)), np.zeros(len(keys), np.int64)
    homes = _homes(keys, order, buckets)
    columns = (answers.column(c).to_pylist() for c in ("bucket", "at", "total"))
    for bucket, codes, values in zip(*columns, strict=True):
        own, code, parts = homes[bucket], _unsqueezed(codes), _unsqueezed(values)
        n = int(code.max()) + 1
        p[own] = parts[:n].astype(np.uint32).view(np.float32)[code]
        left[own[p[own] < 0]] = parts[n:]
    return np.abs(p), p > 0, left


def _zipped(table: pa.Table, names: tuple[str, ...]) -> pa.Table:
    """The binary columns ``names`` compressed, each value after its length."""
    for name in names:
        blobs = [len(x).to_bytes(8) + (pa.compress(x, "zstd", asbytes=True) if x else b"") for x in table.column(name).to_pylist()]
        table = table.set_column(table.schema.get_field_index(name), name, pa.array(blobs, pa.binary()))
    return table


def _unzipped(table: pa.Table, names: tuple[str, ...]) -> pa.Table:
    for name in names:
        blobs = [pa.decompress(x[8:], int.from_bytes(x[:8]), "zstd", asbytes=True) if len(x) > 8 else b"" for x in table.column(name).to_pylist()]
        table = table.set_column(table.schema.get_field_index(name), name, pa.array(blobs, pa.binary()))
    return table


class Exchanged:
    """Sorted numbers of a block, grams or contexts, in the order of their buckets, and the answers to them."""

    def __init__(self, values: np.ndarray, buckets: int):
        self.values = values
        self.order, sizes = _dealt(values.astype(np.uint64), buckets)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))

    def send(self, block: int, counts: np.ndarray) -> pa.Table:
        """One row per bucket: the differences of its numbers, and the counts (one row or several), compressed."""
        values, counts = self.values[self.order], counts[..., self.order]
        used = np.flatnonzero(np.diff(self.starts))
        parts = [slice(self.starts[b], self.starts[b + 1]) for b in used]
        return pa.table(
            {
                "bucket": pa.array(used, pa.int32()),
                "block": pa.array([block] * len(used), pa.int32()),
                "prints": pa.array([_squeezed(np.diff(values[part], prepend=0)) for part in parts], pa.binary()),
                "counts": pa.array([_squeezed(counts[..., part].ravel()) for part in parts], pa.binary()),
            }
        )

    def answered(self, answers: pa.Table, local: np.ndarray) -> np.ndarray:
        out = np.empty(local.shape, np.int64)
        found = totals_of(_unzipped(answers, ("at", "total")), self.starts, local[..., self.order])
        out[..., self.order] = found.astype(np.int64)
        return out


def _answering(answer):
    """A bucket's ``answer`` to what ``Exchanged.send`` has sent, compressed."""

    def answered(rows: pa.Table) -> pa.Table:
        plain = {
            "bucket": rows.column("bucket"),
            "block": rows.column("block"),
            "prints": pa.array([pack64(np.cumsum(_unsqueezed(x))) for x in rows.column("prints").to_pylist()], pa.binary()),
            "counts": pa.array([pack64(_unsqueezed(x)) for x in rows.column("counts").to_pylist()], pa.binary()),
        }
        return _zipped(answer(pa.table(plain)), ("at", "total"))

    return answered


def _gram_totals(found: Grams, grams: Exchanged, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Per gram: its total, and whether this block owns it."""
    doubled = grams.answered(answers, found.counts * 2 + (found.counts > 0))
    return doubled >> 1, doubled & 1


def _own_grams(block: int, found: Grams) -> pa.Table:
    """A block's grams of up to ``SPLIT`` context bytes, which come back to it with what the buckets answer."""
    keys, counts = found.longest
    return pa.table(
        {
            "bucket": pa.array([block], pa.int32()),
            "block": pa.array([block], pa.int32()),
            "prints": pa.array([_squeezed(np.diff(keys, prepend=0))], pa.binary()),
            "counts": pa.array([_squeezed(counts)], pa.binary()),
        }
    )


def _returned(rows: pa.Table) -> pa.Table:
    return rows.select(["block", "bucket", "prints", "counts"]).rename_columns(["block", "bucket", "at", "total"])


def _send_contexts(buckets: int, order: int):
    """Of one block, from its own grams and their totals: what it has of each context."""

    def send(rows: pa.Table) -> pa.Table:
        of_kind = {kind: rows.filter(pc.equal(rows.column("kind"), kind)) for kind in (OWN, GRAMS)}
        own = of_kind[OWN]
        keys, counts = np.cumsum(_unsqueezed(own.column("at")[0].as_py())), _unsqueezed(own.column("total")[0].as_py())
        found = Grams(keys, counts, order, range(order + 1))
        stats = found.local_stats(*_gram_totals(found, Exchanged(found.grams, buckets), of_kind[GRAMS]))
        return Exchanged(found.contexts, buckets).send(own.column("block")[0].as_py(), stats)

    return send


def _model_scores(rows: pa.Table, keys: pa.Table, grams: pa.Table, contexts: pa.Table, buckets: int, order: int) -> np.ndarray:
    texts, training = _texts(rows)
    own, counts, spots = place_contexts(texts, order, training)
    found = Grams(own, counts, order, range(min(order, SPLIT) + 1))
    totals, owned = _gram_totals(found, Exchanged(found.grams, buckets), grams)
    stats = Exchanged(found.contexts, buckets).answered(contexts, found.local_stats(totals, owned))
    state = _states(keys, own, order, buckets) if order > SPLIT else None
    return score(spots, _log10(found.predict(totals, stats, found.lengths, state)), len(texts))


def _tokens(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct token prints of the lower-cased texts, sorted; per token, its place there and its text.

    Each text's last token is the end, whose print is that of a blank, which no word is.
    """
    text = rows.column("text").cast(pa.large_string()).combine_chunks()
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    words, n = split.flatten(), len(split)
    doc = np.repeat(np.arange(n), split.value_lengths().to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(words), 0)
    found = words.filter(real).dictionary_encode()
    distinct = found.dictionary
    ends = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1].tolist() if len(distinct) else []
    data = (distinct.buffers()[2] or pa.py_buffer(b"")).to_pybytes() if len(distinct) else b""
    prints = word_prints([data[a:b] for a, b in zip(ends, ends[1:])] + [b" "])
    prints, place = np.unique(prints, return_inverse=True)
    at = np.concatenate((found.indices.to_numpy(), np.full(n, len(distinct))))
    return prints, place[at], np.concatenate((doc[real.to_numpy(zero_copy_only=False)], np.arange(n)))


def _send(buckets: int, order: int, adaptive: bool):
    """All that a block asks: the counts of its tokens, of its longest grams and of the shorter ones."""

    def send(rows: pa.Table) -> pa.Table:
        texts, training = _texts(rows)
        block = rows.column("block")[0].as_py()
        distinct, group, doc = _tokens(rows)
        sent = {TOKENS: send_counts(block, distinct, np.bincount(group, training[doc], len(distinct)), buckets)}
        if not adaptive:
            keys, counts = count_contexts(texts, order, training)
            found = Grams(keys, counts, order, range(min(order, SPLIT) + 1))
            sent[GRAMS] = Exchanged(found.grams, buckets).send(block, found.counts)
            sent[OWN] = _own_grams(block, found)
            if order > SPLIT:
                sent[KEYS] = _send_keys(block, keys, counts, order, buckets)
        return pa.concat_tables([_of_kind(table, kind) for kind, table in sent.items()])

    return send


def _of_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.add_column(0, "kind", pa.array([kind] * len(table), pa.int32()))


def _answer(kinds: dict):
    """Answer what is sent about ``kinds``, each by its function; nothing else."""
    none = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("bucket", pa.int32()), ("at", pa.binary()), ("total", pa.binary())])

    def answer(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind")[0].as_py()
        if kind not in kinds:
            return none.empty_table()
        return _of_kind(kinds[kind](rows), kind).select(none.names)

    return answer


def _corpus(rows: pa.Table) -> pa.Table:
    """Of one bucket of tokens: its distinct training tokens and how often they occur."""
    if rows.column("kind")[0].as_py() != TOKENS:
        return pa.table({"types": pa.array([], pa.int64()), "tokens": pa.array([], pa.int64())})
    prints = concat([unpack64(x) for x in rows.column("prints").to_pylist()], np.uint64)
    counts = concat([unpack64(x) for x in rows.column("counts").to_pylist()], np.uint64)
    return pa.table(
        {
            "types": pa.array([len(np.unique(prints[counts > 0]))], pa.int64()),
            "tokens": pa.array([int(counts.sum())], pa.int64()),
        }
    )


def _apply(buckets: int, order: int, adaptive: bool):
    def apply(rows: pa.Table, answers: pa.Table) -> pa.Table:
        of_kind = [answers.filter(pc.equal(answers.column("kind"), kind)) for kind in (TOKENS, KEYS, GRAMS, CONTEXTS)]
        texts, training = _texts(rows)
        distinct, group, doc = _tokens(rows)
        local = np.bincount(group, training[doc], len(distinct)).astype(np.uint64)
        found = _unzipped(of_kind[TOKENS], ("at", "total"))
        totals = totals_of(found, bucket_starts(distinct, buckets), local)[group].astype(np.float64)
        n = len(texts)
        if adaptive:
            model = [ByteTrie(order).log10(t, adaptive=True) for t in texts]
        else:
            model = _model_scores(rows, *of_kind[KEYS:], buckets, order)
        return pa.table(
            {
                "id": rows.column("id"),
                "training": rows.column("training"),
                "n_tokens": pa.array(np.bincount(doc, minlength=n), pa.int64()),
                "n_known": pa.array(np.bincount(doc, totals > 0, n).astype(np.int64), pa.int64()),
                "log_counts": pa.array(np.bincount(doc, np.log10(totals + 0.1), n), pa.float64()),
                "score": pa.array(model, pa.float64()),
            }
        )

    return apply


#: What an answer is about.
TOKENS, KEYS, GRAMS, CONTEXTS, OWN = range(5)


def scored(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    mode: str = "pretrained",
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` marks the rows to learn from.  ``score`` is the log10
    probability of the A-Z lower-cased text's bytes.  Null texts are empty:
    one token, the end, and score 0.  Rows repeat as they come, and rows
    without id are scored like others.  An empty corpus leaves N and V at 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    if mode not in ("pretrained", "adaptive"):
        raise ValueError(mode)
    if mode == "pretrained" and order > LONGEST:
        raise ValueError(f"a gram of more than {LONGEST} context bytes does not fit a 64-bit print")
    blocks, n = in_any_blocks(rows, block_bytes)
    short = min(order, SPLIT)
    schema = f"kind int, {SENT}"
    sent = blocks.groupBy("block").applyInArrow(_send(n, order, mode == "adaptive"), schema).groupBy("kind", "bucket")
    totals = sent.applyInArrow(_corpus, "types long, tokens long")
    size = totals.agg(F.coalesce(F.sum("types"), F.lit(0)).alias("v"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"))
    about_tokens = {TOKENS: lambda rows: _zipped(shared_counts(rows), ("at", "total"))}
    about_grams = {GRAMS: _answering(owned_counts)}
    answered = f"kind int, {COUNTS}"
    answers = sent.applyInArrow(_answer({**about_tokens, **about_grams, KEYS: _predict_keys(order)}), answered)
    if mode == "pretrained":
        grams = sent.applyInArrow(_answer({**about_grams, OWN: _returned}), answered)
        contexts = grams.groupBy("block").applyInArrow(_send_contexts(n, short), SENT)
        contexts = contexts.groupBy("bucket").applyInArrow(_answering(shared_counts), COUNTS)
        answers = answers.unionByName(contexts.withColumn("kind", F.lit(CONTEXTS)))
    scores = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _apply(n, order, mode == "adaptive"),
        "id long, training boolean, n_tokens long, n_known long, log_counts double, score double",
    )
    n_train = size.select("n").scalar()
    unit = F.log10(n_train + 0.1 * (size.select("v").scalar() + 1))
    return scores.select(
        "id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        n_train.alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * unit).alias("base_score"),
        "score",
    )
