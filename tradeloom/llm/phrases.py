"""Phrase collocations by vertical partitioning of depth-truncated suffixes.

1. Words are counted per language.
2. Prefixes of two frequent words are counted: those below the support can
   begin nothing, so suffixes are truncated there, and at ``longest`` words.
3. Suffixes are dealt to groups by their prefix of two words; a prefix with more
   occurrences than a group's memory budget is extended to all its words.
   Every group sorts its suffixes: equal beginnings are then the nodes of their
   tree, and a node's count is the total of its leaves.
4. Phrases are joined with the counts of their parts, scored and ranked.

What is frequent, and which prefixes are extended, is sent to the tasks as
bitmaps of a fixed size over hashes.  A hash that meets another one's bit makes
a suffix longer or an extension needless; counts come from the words themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.llm.common import written
from tradeloom.llm.prints import mix, multipliers, runs, word_prints

#: A phrase needs so many occurrences, and has so many words at most.
SUPPORT = 100
LONGEST = 5
#: Phrases that are returned for a language.
TOP = 2000
UNKNOWN = "und"
# Suffixes of a group, counted before equal ones are put together.
BUDGET = 1 << 18
# Bits of the bitmaps, as a power of two: 16 MB.  Beyond some hundred million frequent prefixes take more.
BITS = 27
# Spark's bitmap functions make pieces of so many bits.
BITMAP = 32768
# Text that is tokenized at once, and distinct rows that a task puts together.
CHUNK = 1 << 20
HELD = 1 << 18
# Rows of a batch that are taken out of Arrow at once.
SLICE = 512

BREAK = b"\xff"  # never in UTF-8
#: Lower-cases A-Z, and ends pieces at [.,;:!?\x0A-\x0D].
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10)
BREAK_PRINT = np.uint64(xxhash.xxh64_intdigest(BREAK))


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Words and breaks of some MB of texts; only a longer piece makes a longer chunk."""
    held, size = [], 0
    for text in texts:
        text = text.translate(LETTERS)
        start = 0
        while len(text) - start > CHUNK:
            cut = text.find(BREAK, start + CHUNK)
            if cut < 0:
                break
            yield text[start:cut].replace(BREAK, b" \xff ").split()
            start = cut + 1
        held.append(text[start:])
        size += len(text) - start
        if size >= CHUNK:
            yield BREAK.join(held).replace(BREAK, b" \xff ").split()
            held, size = [], 0
    if size:
        yield BREAK.join(held).replace(BREAK, b" \xff ").split()


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for start in range(0, len(batch), SLICE):
        rows = batch.slice(start, SLICE)
        langs = np.asarray(rows.column("lang").to_pylist(), dtype=object)
        texts = rows.column("text").cast(pa.binary()).to_pylist()
        for lang in sorted(set(langs)):
            for words in _chunks([texts[i] for i in np.flatnonzero(langs == lang) if texts[i]]):
                if words:
                    yield lang, words


class Counter:
    """Counts by 64-bit key, with one value each; put together whenever many are held."""

    def __init__(self, values: pa.DataType | None):
        self.type, self.parts, self.size = values, [], 0
        self.held = HELD if values is None or pa.types.is_binary(values) else HELD // 2  # what has several values takes more room

    def add(self, keys: np.ndarray, counts: np.ndarray, values: pa.Array | None) -> None:
        self.parts.append((keys, counts, values))
        self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        keys = np.concatenate([p[0] for p in self.parts])
        distinct, first, group = np.unique(keys, return_index=True, return_inverse=True)
        counts = np.bincount(group, np.concatenate([p[1] for p in self.parts])).astype(np.int64)
        values = pa.concat_arrays([p[2] for p in self.parts]).take(pa.array(first)) if self.type else None
        return distinct, counts, values

    def full(self) -> bool:
        """Whether many distinct keys are held, even after equal ones are one."""
        if self.size < self.held:
            return False
        self.parts = [self.merged()]
        self.size = len(self.parts[0][0])
        return self.size >= self.held // 2


def _counted(
    batches: Iterator[pa.RecordBatch],
    of_words: Callable[[str, list[bytes]], tuple[np.ndarray, np.ndarray, pa.Array | None]],
    values: pa.DataType | None,
    rows: Callable[[str, np.ndarray, np.ndarray, pa.Array | None], pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """``rows`` of the task's counts, per language."""
    held: dict[str, Counter] = {}
    for batch in batches:
        for lang, words in _by_language(batch):
            own = held.setdefault(lang, Counter(values))
            own.add(*of_words(lang, words))
            if own.full():
                yield rows(lang, *held.pop(lang).merged())
    for lang, own in held.items():
        yield rows(lang, *own.merged())


def _salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=1))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def of_words(lang: str, words: list[bytes]):
        prints, first, counts = np.unique(word_prints(words), return_index=True, return_counts=True)
        real = prints != BREAK_PRINT
        return prints[real], counts[real], pa.array([words[i] for i in first[real]], pa.binary())

    def rows(lang: str, prints: np.ndarray, counts: np.ndarray, words: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(words), pa.string()), "phrase": words.cast(pa.string()), "n": counts})

    yield from _counted(batches, of_words, pa.binary(), rows)


def _has(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether the bits of these prints' upper bits are set."""
    cell = prints >> np.uint64(64 - int(math.log2(len(bitmap) * 8)))
    return (bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _salted(lang: str, prints: np.ndarray) -> np.ndarray:
    return mix(prints + _salt(lang))


PAIR = multipliers(2, 2)


def _pair_prints(lang: str, prints: np.ndarray) -> np.ndarray:
    """Prints of each word and the next one."""
    return mix(prints[:-1] * PAIR[0] + prints[1:] * PAIR[1] + _salt(lang))


def _pair_counts(frequent_words):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_words(lang: str, words: list[bytes]):
            prints = word_prints(words)
            good = (prints != BREAK_PRINT) & _has(frequent_words.value, _salted(lang, prints))
            return *np.unique(_pair_prints(lang, prints)[good[:-1] & good[1:]], return_counts=True), None

        def rows(lang: str, keys: np.ndarray, counts: np.ndarray, _) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"pair": keys.view(np.int64), "n": counts})

        yield from _counted(batches, of_words, None, rows)

    return pairs


def _suffixes(frequent_pairs, heavy_pairs, groups: int, longest: int):
    """Suffixes of at least two words with counts and whether their prefix is extended: a row per language and group of what a task holds."""
    weights = multipliers(longest, 3)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_words(lang: str, words: list[bytes]):
            prints = word_prints(words)
            pairs = _pair_prints(lang, prints)
            real = prints != BREAK_PRINT
            good = np.append(real[:-1] & real[1:] & _has(frequent_pairs.value, pairs), False)
            start = np.flatnonzero(good)
            length, key, going = np.ones(len(start), np.int64), prints[start] * weights[0], np.ones(len(start), bool)
            for n in range(1, longest):
                at = np.minimum(start + n, len(words) - 1)
                going &= good[np.minimum(start + n - 1, len(words) - 1)]
                key = np.where(going, key + prints[at] * weights[n], key)
                length += going
            key = mix(key + length.astype(np.uint64))
            key, first, counts = np.unique(key, return_index=True, return_counts=True)
            texts = [b" ".join(words[a:b]) for a, b in zip(start[first].tolist(), (start + length)[first].tolist(), strict=True)]
            pair = pairs[start[first]]
            heavy = _has(heavy_pairs.value, pair)
            group = (np.where(heavy, key, pair) % np.uint64(groups)).astype(np.int32)
            return key, counts, pa.StructArray.from_arrays([pa.array(texts, pa.binary()), pa.array(group), pa.array(heavy)], ["text", "group", "heavy"])

        def rows(lang: str, keys: np.ndarray, counts: np.ndarray, found: pa.StructArray) -> pa.RecordBatch:
            group, heavy, texts = np.asarray(found.field("group")), np.asarray(found.field("heavy")), found.field("text").to_pylist()
            order = np.argsort(group, kind="stable")
            heads = runs(group[order])
            packs = [order[a:b] for a, b in zip(heads, np.append(heads[1:], len(order)), strict=False)]
            return pa.RecordBatch.from_pydict(
                {
                    "group": pa.array(group[order[heads]], pa.int32()),
                    "lang": pa.array([lang] * len(packs), pa.string()),
                    "suffixes": pa.array([b"\n".join([texts[i] for i in own]) for own in packs], pa.binary()),
                    "counts": pa.array([counts[own].tobytes() for own in packs], pa.binary()),
                    "heavy": pa.array([heavy[own].tobytes() for own in packs], pa.binary()),
                }
            )

        kind = pa.struct([("text", pa.binary()), ("group", pa.int32()), ("heavy", pa.bool_())])
        yield from _counted(batches, of_words, kind, rows)

    return suffixes


def subtrees(suffixes: list[bytes], langs: list[str], counts: np.ndarray, heavy: np.ndarray, support: int, longest: int) -> pa.Table:
    """The nodes of the tree of suffixes (two words or more) that have the support, or lie below an extended prefix.

    Suffixes are sorted by language and words; the leaves of a node, that is the
    suffixes that begin with its words, are then neighbours.
    """
    words = b" ".join(suffixes).split(b" ")
    sizes = np.array([s.count(b" ") + 1 for s in suffixes], np.int64)
    starts = np.cumsum(sizes) - sizes
    code = np.append(np.asarray(pa.array(words, pa.binary()).dictionary_encode().indices), -1)
    lang_code = np.asarray(pa.array(langs).dictionary_encode().indices)
    columns = [lang_code] + [code[np.where(sizes > d, starts + d, len(words))] for d in range(longest)]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    differs = np.concatenate(([True], columns[0][1:] != columns[0][:-1]))
    out = {"lang": [], "phrase": [], "words": [], "n": []}
    for depth in range(1, longest + 1):
        differs[1:] |= columns[depth][1:] != columns[depth][:-1]
        if depth == 1:
            continue
        heads = np.flatnonzero(differs)
        totals = np.add.reduceat(counts[order], heads)
        heads_rows = order[heads]
        taken = np.flatnonzero((sizes[heads_rows] >= depth) & ((totals >= support) | heavy[heads_rows]))
        for i, n in zip(heads_rows[taken].tolist(), totals[taken].tolist(), strict=True):
            out["lang"].append(langs[i])
            out["phrase"].append(b" ".join(words[starts[i] : starts[i] + depth]))
            out["words"].append(depth)
            out["n"].append(n)
    out["phrase"] = pa.array(out["phrase"], pa.binary()).cast(pa.string())
    return pa.table(out, schema=pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())]))


def _grown(support: int, longest: int):
    def grown(rows: pa.Table) -> pa.Table:
        packs = [x.split(b"\n") for x in rows.column("suffixes").to_pylist()]  # no word holds a line end
        langs = [lang for lang, own in zip(rows.column("lang").to_pylist(), packs, strict=True) for _ in own]
        counts, heavy = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in (("counts", np.int64), ("heavy", bool)))
        return subtrees([x for own in packs for x in own], langs, counts, heavy, support, longest)

    return grown


def _bitmap(prints: DataFrame, bits: int):
    """A broadcast bitmap of 2 ** bits bits, one for the upper bits of each print (long)."""
    cell = F.shiftrightunsigned("print", 64 - bits)
    cells = prints.select((cell / BITMAP).cast("int").alias("piece"), (cell % BITMAP).alias("bit"))
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for row in cells.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        at = row.piece * (BITMAP // 8)
        part = np.frombuffer(row.bits, np.uint8)
        whole[at : at + BITMAP // 8] = part[: len(whole) - at]
    return prints.sparkSession.sparkContext.broadcast(whole)


def _prints_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = word_prints(batch.column("phrase").cast(pa.binary()).to_pylist())
        langs = batch.column("lang").to_pylist()
        salt = {lang: _salt(lang) for lang in set(langs)}
        yield pa.RecordBatch.from_pydict({"print": mix(prints + np.array([salt[x] for x in langs], np.uint64)).view(np.int64)})


def phrase_counts(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, budget: int = BUDGET, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """Of docs (text, lang): words (lang, phrase, n), all of them; and phrases (lang, phrase, words, n) that have the support."""
    words = docs.mapInArrow(_word_counts, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    frequent = _bitmap(words.where(F.col("n") >= support).select("lang", "phrase").mapInArrow(_prints_of, "print long"), bits)
    pairs = docs.mapInArrow(_pair_counts(frequent), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = written(pairs.where(F.col("n") >= support), "pairs")
    occurrences = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    kept = _bitmap(pairs.select(F.col("pair").alias("print")), bits)
    heavy = _bitmap(pairs.where(F.col("n") > budget).select(F.col("pair").alias("print")), bits)
    groups = max(1, math.ceil(occurrences / budget))
    suffixes = docs.mapInArrow(_suffixes(kept, heavy, groups, longest), "group int, lang string, suffixes binary, counts binary, heavy binary")
    nodes = suffixes.groupBy("group").applyInArrow(_grown(support, longest), "lang string, phrase string, words int, n long")
    phrases = nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    return words, written(phrases, "phrases")


def _whole(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int = TOP,
    covered: int = 100,
    budget: int = BUDGET,
    bits: int = BITS,
) -> DataFrame:
    """Per language its ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    Words are runs of anything but blanks and tabs, in pieces between
    ``.,;:!?`` and line ends, A-Z lower-cased; phrases stay within pieces.  A
    phrase with a >= ``support`` occurrences is scored by its weakest cut into
    two parts of l and r occurrences: floor(1000 a n / (l r)), n being all words
    of the language; ties to the first cut.  A phrase goes if a longer one that
    holds it has at least ``covered`` percent of its occurrences.  Ranks are by
    score, then a, both descending, then by the phrase's bytes.

    Null languages count as ``und``; null and empty texts have no words.  A text
    is taken in chunks of some MB at piece ends, so only a single piece of
    hundreds of MB is too long.  Equal rows count as often as they come.  An
    empty table gives no rows.  Other columns are not read, so their names
    cannot clash.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    words, phrases = phrase_counts(rows, support, longest, budget, bits)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("total"))
    parts = words.where(F.col("n") >= support).unionByName(phrases.select("lang", "phrase", "n"))
    named = phrases.withColumn("w", F.split("phrase", " ")).withColumnRenamed("n", "a")
    piece = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = named.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("left"), piece(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(sizes, "lang").withColumn("product", F.lit(1000).cast("decimal(4,0)") * _whole("a") * _whole("total"))
    cuts = cuts.withColumn("parts", (F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")))
    cuts = cuts.withColumn("score", F.expr("product div parts"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("total").alias("n"), weakest)
    # What each longer phrase covers: its proper parts of two words or more.
    spans = F.expr(
        "flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1), at -> array_join(slice(w, at, size), ' '))))"
    )
    inner = named.where(F.col("words") > 2).select("lang", F.explode(spans).alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_whole("longer") * 100 < _whole("a") * F.lit(covered))
    )
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
