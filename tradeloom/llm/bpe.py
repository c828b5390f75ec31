"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A leaf per adjacent pair holds (rank of the merge, position), an inner node the
smaller of its two; so the root is the leftmost pair of lowest rank.  A merge
changes three leaves and their paths to the root, in logarithmic time, until
the root holds no mergeable pair.  Trees of many words of similar length are
kept as one matrix and advance together; very long words go one by one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.unicode_edges import NO_LETTERS, normalised

#: White space of the tokenizer's patterns: Unicode's White_Space.
SPACE = "\t-\r \x85\xa0  -     　"
#: What Python's split takes for white space, but the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
NO_PAIR = np.int64(1) << 62
# Words with more pairs than this go through a tree of their own.
LONG_WORD = 256
# Cells of one matrix of trees.
CELLS = 1 << 18
# Distinct chunks whose encodings a task remembers; then it starts afresh.
REMEMBERED = 150_000
# Rows whose chunks are learnt together, and rows of one output batch: ids take more room than texts.
IN_ROWS, OUT_ROWS = 768, 256


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printable)
    signs = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [signs[b] for b in range(256)]


class Merges:
    """A BPE vocabulary as arrays: symbols of the bytes, and the merges sorted by pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for text, i in (vocab | self.special).items():
            self.tokens[i] = text
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in map(self._pair, model["merges"])]
        self.size = size
        keys = np.array([a * size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([c for _, _, c in pairs], np.int64)  # by rank
        self.pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        ).replace("\\s", SPACE)

    @staticmethod
    def _pair(merge) -> tuple[str, str]:
        return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, or -1."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)

    def symbols(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, np.uint8)
        out = self.inner[raw]
        out[-1] = self.last[raw[-1]]
        return out


def merge_word(merges: Merges, symbols: np.ndarray) -> list[int]:
    """Merge one word through a segment tree."""
    n = len(symbols)
    sym = symbols.tolist()
    if n < 2:
        return sym
    width = 1 << (n - 2).bit_length()
    ranks = merges.rank(symbols[:-1], symbols[1:])
    none = int(NO_PAIR)
    leaves = np.full(width, none, np.int64)
    leaves[: n - 1] = np.where(ranks >= 0, ranks * width + np.arange(n - 1), none)
    tree = [none] * width + leaves.tolist()
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    keys = getattr(merges, "by_pair", None)
    if keys is None:
        keys = merges.by_pair = dict(zip(merges.keys.tolist(), merges.ranks.tolist(), strict=True))
    merged, size = merges.merged, merges.size

    def put(i: int, j: int) -> None:
        rank = keys.get(sym[i] * size + sym[j], -1) if j >= 0 else -1
        k = width + i
        tree[k] = none if rank < 0 else rank * width + i
        while k > 1:
            k >>= 1
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        j = after[i]
        sym[i], sym[j] = int(merged[rank]), -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if j < width:
            put(j, -1)
        put(i, after[i])
        if before[i] >= 0:
            put(before[i], i)
    return [s for s in sym if s >= 0]


def _merge_matrix(merges: Merges, sym: np.ndarray, lengths: np.ndarray) -> None:
    """Merge the words in the rows of ``sym`` (padded with -1) in place; merged-away symbols become -1."""
    rows, n = sym.shape
    width = 1 << max(n - 2, 0).bit_length()
    shift, mask = np.int64(width.bit_length() - 1), np.int64(width - 1)
    tree = np.full((rows, 2 * width), NO_PAIR, np.int64)
    ranks = merges.rank(sym[:, :-1], sym[:, 1:])
    tree[:, width : width + n - 1] = np.where(ranks >= 0, (ranks << shift) + np.arange(n - 1), NO_PAIR)
    level = width
    while level > 1:
        half = level >> 1
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half
    # One more column takes what is written before the first or after the last symbol.
    after = np.broadcast_to(np.arange(1, n + 1), (rows, n)).copy()
    after[after >= lengths[:, None]] = n
    after = np.hstack([after, np.full((rows, 1), n)])
    before = np.hstack([np.broadcast_to(np.arange(-1, n - 1), (rows, n)), np.full((rows, 1), n)])
    before[:, 0] = n
    wide = np.hstack([sym, np.full((rows, 1), -1, np.int64)])

    def put(row: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
        k = width + i
        tree[row, k] = value
        while k[0] > 1:  # all leaves are equally deep
            k = k >> 1
            tree[row, k] = np.minimum(tree[row, 2 * k], tree[row, 2 * k + 1])

    row = np.flatnonzero(tree[:, 1] < NO_PAIR)
    while len(row):
        root = tree[row, 1]
        i = root & mask
        j = after[row, i]
        wide[row, i] = merges.merged[root >> shift]
        wide[row, j] = -1
        following = after[row, j]
        after[row, i] = following
        before[row, following] = i
        put(row, np.minimum(j, width - 1), np.where(j < width, NO_PAIR, tree[row, 2 * width - 1]))
        rank = merges.rank(wide[row, i], wide[row, following])
        put(row, i, np.where(rank >= 0, (rank << shift) + i, NO_PAIR))
        leading = before[row, i]
        some = np.flatnonzero(leading < n)
        if len(some):
            r, p = row[some], leading[some]
            rank = merges.rank(wide[r, p], wide[r, i[some]])
            put(r, p, np.where(rank >= 0, (rank << shift) + p, NO_PAIR))
        row = row[tree[row, 1] < NO_PAIR]
    sym[:] = wide[:, :n]


def merge_words(merges: Merges, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids of all words, one after another in any order, and where those of each word start and end."""
    starts, ends = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    parts, done = [], 0
    by_width: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        n = len(word)
        if n > LONG_WORD:
            parts.append(np.array(merge_word(merges, merges.symbols(word)), np.int64))
            starts[i], done = done, done + len(parts[-1])
            ends[i] = done
        else:
            by_width.setdefault(n if n <= 24 else -(-n // 16) * 16, []).append(i)
    for width, members in by_width.items():
        step = max(1, CELLS // width)
        for start in range(0, len(members), step):
            part = members[start : start + step]
            lengths = np.array([len(words[i]) for i in part])
            raw = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in part]), np.uint8).reshape(-1, width)
            sym = merges.inner[raw]
            sym[np.arange(width) >= lengths[:, None]] = -1
            last = (np.arange(len(part)), lengths - 1)
            sym[last] = merges.last[raw[last]]
            if width > 1:
                _merge_matrix(merges, sym, lengths)
            kept = sym >= 0
            parts.append(sym[kept])
            until = done + np.cumsum(kept.sum(axis=1))
            ends[part] = until
            starts[part] = np.concatenate(([done], until[:-1]))
            done = int(until[-1])
    return np.concatenate(parts) if parts else np.empty(0, np.int64), starts, ends


class Encoder:
    """Encodes texts; remembers the encodings of chunks between white space."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words = regex.compile(merges.pattern)
        self.spaces = re.compile(f"[{SPACE}]+")
        self.special = re.compile("(" + "|".join(map(re.escape, merges.special)) + ")") if merges.special else None
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def split(self, text: str) -> list[str]:
        """The normalised text's chunks; a special token is a chunk of its own after a blank."""
        if self.special and "<|" in text:
            out = []
            for part in self.special.split(text):
                out += [" " + part] if part in self.merges.special else self.split_plain(part)
            return out
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        text = text.lower() if text.isascii() else normalised(text)
        if SEPARATORS.search(text):
            return [c for c in self.spaces.split(text) if c]
        return text.split()

    def pieces(self, chunk: str) -> list[str]:
        if chunk.isascii() or not NO_LETTERS.search(chunk):
            return self.words.findall(chunk)
        return [chunk[m.start() : m.end()] for m in self.words.finditer(NO_LETTERS.sub("\ufffd", chunk))]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that are not remembered yet."""
        new = chunks - self.ids.keys()
        if len(self.ids) + len(new) > REMEMBERED:
            self.ids.clear()
            self.decoded.clear()
            new = chunks
        whole = [c for c in new if c.isalpha()]
        mixed = [c for c in new if not c.isalpha() and c[0] != " "]
        pieces = [self.pieces(c) for c in mixed]
        whole += {p for own in pieces for p in own} - self.ids.keys() - new.intersection(whole)
        flat, starts, ends = merge_words(self.merges, [w.encode() for w in whole])
        raw = flat.astype("<u4").tobytes()
        names = list(map(self.merges.tokens.__getitem__, flat.tolist()))
        for word, a, b in zip(whole, starts.tolist(), ends.tolist(), strict=True):
            self.ids[word] = raw[4 * a : 4 * b]
            self.decoded[word] = " ".join(names[a:b])
        for chunk, own in zip(mixed, pieces, strict=True):
            if len(own) > 1:
                self.ids[chunk] = b"".join(map(self.ids.__getitem__, own))
                self.decoded[chunk] = " ".join(map(self.decoded.__getitem__, own))
        for token, i in self.merges.special.items():
            self.ids[" " + token] = np.array([i], "<u4").tobytes()
            self.decoded[" " + token] = token

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text.

        Decoding joins the tokens' strings by blanks, as the vocabulary file
        names no decoder.
        """
        split = [self.split(t) for t in texts]
        chunks: set[str] = set()
        for own in split:
            chunks.update(own)
        self.learn(chunks)
        for own in split:
            yield b"".join(map(self.ids.__getitem__, own)), " ".join(map(self.decoded.__getitem__, own))


def _encode(shared):
    def encode(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, IN_ROWS):
                part = batch.slice(start, IN_ROWS)
                found = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                for at in range(0, part.num_rows, OUT_ROWS):
                    own = part.column("id").slice(at, OUT_ROWS)
                    ids, decoded = zip(*islice(found, len(own)), strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=["id", "ids", "decoded"]
                    )

    return encode


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ids (little-endian unsigned 32-bit integers) and the text decoded from them.

    ``path`` is the vocabulary file on the driver; its arrays are broadcast.
    Null texts are empty and have no tokens.  Rows repeat as they come; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Merges(path))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(shared), "id long, ids binary, decoded string")
