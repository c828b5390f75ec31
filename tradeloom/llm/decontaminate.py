"""Benchmark decontamination: a prefix-filtered set join over item-sized windows, in DataFrame functions only.

A window (``WINDOW`` consecutive words of an item, or all words of a shorter
one) occurs in a document only if all its shingles do.  For full containment
the necessary prefix of a window's shingles, ordered by rarity in the whole
corpus, is its single rarest one.  So documents are probed by that shingle
alone; its offset in the window gives the only place the window can start;
places outside the document are dropped, and the rest are compared word by
word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import sha256_utf8, size_of, written

WINDOW = 10
SHINGLE = 3
# Files of items up to this size are broadcast: at most some 300,000 windows of ten words each.
BROADCAST_BYTES = 1 << 20
#: What separates words once A-Z are lower-cased: ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Print of the one row that each document sends for itself.
HEADER = 0


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none if it is null."""
    text = F.coalesce(text, F.lit(""))
    # ``lower`` is the faster one, but also changes other letters.
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def shingle_prints(words: str, size: int) -> Column:
    """Prints of all runs of ``size`` words of a column, in order."""
    run = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return F.expr(
        f"IF(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), i -> xxhash64({run})), "
        f"CAST(array() AS array<bigint>))"
    )


def item_windows(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """Distinct windows: win (words), items (ids of the items that have it, sorted as strings)."""
    words = items.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    places = F.expr(f"IF(size(words) > {width}, sequence(1, size(words) - {width - 1}), array(1))")
    windows = words.where("size(words) > 0").select("item", "words", F.explode(places).alias("at"))
    return (
        windows.select("item", F.slice("words", F.col("at"), F.lit(width)).alias("win"))
        .groupBy("win")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
) -> DataFrame:
    """Per document: id, digest (MD5 of the text), n_words, n_hit, spans (start, end of words), items (ids of items with occurring windows).

    Rows of equal id and text are one document.  Null texts have no words;
    items without words have no window; null item ids are not listed.  The
    windows are broadcast only if the items' files are below
    ``BROADCAST_BYTES``; beyond, the join is a shuffle by shingle that carries
    the words around each.
    """
    size = size_of(items)
    small = size is not None and size <= BROADCAST_BYTES
    windows = written(item_windows(items, item_col, item_text_col, width), "windows")
    rows = docs.select(F.col(id_col).alias("id"), F.md5(F.col(text_col).cast("binary")).alias("digest"), words_of(F.col(text_col)).alias("words"))
    sizes = [r["size"] for r in windows.select(F.least(F.size("win"), F.lit(SHINGLE)).alias("size")).distinct().collect()]
    sizes = sorted(sizes, reverse=True) or [SHINGLE]

    parts = []
    for n in sizes:
        own = windows.where(F.least(F.size("win"), F.lit(SHINGLE)) == n)
        placed = own.select("win", "items", F.posexplode(shingle_prints("win", n)).alias("offset", "print"))
        corpus = rows.select(shingle_prints("words", n).alias("prints")).select(F.explode_outer("prints").alias("print"))
        counted = corpus.join(_small(placed.select("print").distinct(), small), "print").groupBy("print").agg(F.count(F.lit(1)).alias("n"))
        prefix = (
            # A shingle that no document has rules its window out.
            placed.join(_small(counted, small), "print", "left")
            .groupBy("win", "items")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "print", "offset")).alias("rarest"))
            .where("rarest.n > 0")
            .select("win", "items", "rarest.print", "rarest.offset")
        )
        parts.append(written(prefix, f"prefix{n}"))

    found = []
    for n, prefix in zip(sizes, parts, strict=True):
        prints = shingle_prints("words", n)
        if n == sizes[0]:  # every document also sends one row for itself, before its first shingle
            nothing = "CAST(array() AS array<string>) AS win, CAST(array() AS array<string>) AS items"
            head = prefix.sparkSession.range(1).selectExpr(*nothing.split(", "), f"CAST({HEADER} AS bigint) AS print", "0 AS offset")
            prefix, prints = prefix.unionByName(head), F.concat(F.array(F.lit(HEADER).cast("long")), prints)
            first = 0
        else:
            first = 1
        # The prints are a column before they are exploded: the rest is then one stage of generated code,
        # in which the words are a reference, not a copy for each row.  Outer, as otherwise a filter on
        # the size of the array is pushed below the split and repeats it for every word.
        placed = (
            rows.withColumn("prints", prints)
            .select("id", "digest", "words", F.posexplode_outer("prints").alias("at", "print"))
            .withColumn("at", F.col("at") + first)
        )
        if small:
            joined = placed.join(F.broadcast(prefix), "print")
            n_words, around, shift = F.size("words"), F.col("words"), F.lit(0)
        else:
            lead = F.greatest(F.col("at") - width, F.lit(0))
            placed = placed.select(
                "id", "digest", "at", "print", F.size("words").alias("n"), F.slice("words", lead + 1, F.lit(2 * width)).alias("around"), lead.alias("lead")
            )
            joined = placed.join(prefix, "print")
            n_words, around, shift = F.col("n"), F.col("around"), F.col("lead")
        start = F.col("at") - F.col("offset")  # first word of the window, from 1
        length = F.size("win")
        header = (F.col("at") == 0) & (length == 0)
        inside = (F.col("at") > 0) & (length > 0) & (start >= 1) & (start + length - 1 <= n_words)
        same = F.slice(around, F.greatest(start - shift, F.lit(1)), F.greatest(length, F.lit(1))) == F.col("win")
        found.append(
            joined.where(header | (inside & same)).select(
                "id",
                "digest",
                n_words.alias("n_words"),
                F.when(~header, F.struct((start - 1).alias("start"), (start - 1 + length).alias("end"))).alias("span"),
                "items",
            )
        )
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    # A document's spans and items are bounded by its own words and the items.
    grouped = hits.groupBy("id", "digest").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'upto', 0), (acc, s) -> named_struct("
        "'n', acc.n + greatest(s.end - greatest(s.start, acc.upto), 0), 'upto', greatest(acc.upto, s.end))).n"
    )
    return grouped.select("id", "digest", "n_words", covered.alias("n_hit"), "spans", "items")


def digest_of(items: Column) -> Column:
    """SHA-256 of the item ids, comma-joined."""
    return sha256_utf8(F.concat_ws(",", items))
