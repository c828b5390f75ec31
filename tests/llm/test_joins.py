"""Decontamination, near-duplicates and substring dedup against brute force."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs, texts
from tradeloom.llm import common, decontaminate, near_dup, prints, substring
from tradeloom.llm.components import components

ITEMS = [
    (1, "tok90 tok91 tok92 tok93 tok94 tok95 tok96 tok97 tok98 tok99 tok100 tok101"),
    (2, "Short, TEXT!"),
    (10, "short text"),
    (3, None),
    (4, "..."),
    (5, "été"),
    (6, "nothing of this is anywhere in the documents at all really"),
    (1, "tok90 tok91 tok92 tok93 tok94 tok95 tok96 tok97 tok98 tok99 tok100 tok101"),
]
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def folded(text):
    return WORD.findall((text or "").translate(FOLD))


def expected_hits(rows, items, width=10):
    windows = {}
    for item, text in items:
        words = folded(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(str(item))
    out = {}
    for key, text in rows:
        words, covered, found = folded(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    covered.update(range(i, i + len(window)))
                    found |= ids
        out[key, text] = (len(words), len(covered), sorted(found))
    return Counter((k[0], *map(str, v)) for k, v in out.items())


@pytest.mark.parametrize("limit", [1 << 60, -1])  # broadcast, and shuffled by shingle
def test_contamination_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(decontaminate, "size_of", lambda df: 0)
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    found = decontaminate.contamination(docs(spark), items).collect()
    got = Counter((r["id"], str(r["n_words"]), str(r["n_hit"]), str(list(r["items"]))) for r in found)
    assert got == expected_hits(texts(), ITEMS)


def test_contamination_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs(spark, []), items).count() == 0
    found = decontaminate.contamination(docs(spark), items)
    assert found.where("n_hit > 0").count() == 0 and found.where("id = 1 and n_words = 200").count() == 1


def expected_kept(rows, width):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, own in words:
        for p in range(len(own) - width + 1):
            if i is not None:
                key = tuple(own[p : p + width])
                first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, own in words:
        covered = set()
        for p in range(len(own) - width + 1):
            if i is not None and first[tuple(own[p : p + width])] < i:
                covered.update(range(p, p + width))
        out[i, len(own), len(covered), b" ".join(w for q, w in enumerate(own) if q not in covered).decode()] += 1
    return out


@pytest.mark.parametrize("blocks", [1, 5])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr("tradeloom.llm.common.part_count", lambda df, size: blocks)
    found = substring.remove_repeats(docs(spark)).collect()
    assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == expected_kept(texts(), 13)
    for r in found:
        edges = r["removed_spans"]
        assert sum(b - a for a, b in zip(edges[::2], edges[1::2], strict=True)) == r["n_removed"]


@pytest.mark.parametrize("repeated", [None, 7])
def test_no_block_gathers_rows_of_one_id(spark, monkeypatch, repeated):
    monkeypatch.setattr("tradeloom.llm.common.part_count", lambda df, size: 8)
    rows = docs(spark, [(i, f"text {i}") for i in range(100, 200)] + [(repeated, f"own {i}") for i in range(100)]).select("doc_id", "text")
    blocks = [common.in_any_blocks(rows)[0], *([common.in_blocks(rows, "doc_id")[0]] if repeated is None else [])]
    for found in blocks:
        sizes = [r["count"] for r in found.where(F.col("doc_id").eqNullSafe(repeated)).groupBy("block").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 40
    found = substring.remove_repeats(docs(spark, texts() + [(None, f"{texts()[0][1]} {i}") for i in range(20)])).where("id IS NULL")
    assert found.count() == 22 and found.where("n_removed > 0 OR longest_repeat > 0").count() == 0


@pytest.mark.parametrize(("min_words", "first_bytes"), [(1, 6), (2, 6), (7, 2), (13, 1)])
def test_first_level_only_finds_candidates(spark, monkeypatch, min_words, first_bytes):
    monkeypatch.setattr("tradeloom.llm.common.part_count", lambda df, size: 5)
    found = substring.remove_repeats(docs(spark), min_words=min_words, first_bytes=first_bytes).collect()
    assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == expected_kept(texts(), min_words)


def test_windows_without_repeated_parts_do_not_travel(spark, monkeypatch):
    monkeypatch.setattr("tradeloom.llm.common.part_count", lambda df, size: 3)
    tables = {}
    write = substring.written
    monkeypatch.setattr(substring, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    shared = " ".join(f"s{i}" for i in range(20))
    rows = [(1, f"a b c {shared}"), (2, f"{shared} d e f"), (3, " ".join(f"u{i}" for i in range(500))), (4, "a b c d e f " + " ".join(f"v{i}" for i in range(99)))]
    substring.remove_repeats(docs(spark, rows)).collect()
    left = {r["id"]: (len(r["prints"]) // 8, r["text"]) for r in tables["first_level"].collect()}
    assert left == {1: (8, rows[0][1]), 2: (8, rows[1][1]), 3: (0, None), 4: (0, None)}


def expected_longest(rows, width):
    words = [(i, tuple((t or "").encode().split())) for i, t in rows]
    out = {}
    while True:
        owners = {}
        for i, own in words:
            for p in range(len(own) - width + 1):
                if i is not None:
                    owners.setdefault(own[p : p + width], set()).add(i)
        repeated = {w for w, ids in owners.items() if len(ids) > 1}
        for i, own in words:
            if i is not None and any(own[p : p + width] in repeated for p in range(len(own) - width + 1)):
                out[i, own] = width
        if not repeated:
            return Counter((i, len(own), out.get((i, own), 0)) for i, own in words)
        width *= 2


@pytest.mark.parametrize("blocks", [1, 5])
def test_repeats_double_until_none_is_left(spark, monkeypatch, blocks):
    monkeypatch.setattr("tradeloom.llm.common.part_count", lambda df, size: blocks)
    long = [f"r{i}" for i in range(200)]
    rows = [*texts(), (900, " ".join(long)), (901, " ".join(["x", *long[:103]])), (902, " ".join([*long[97:], "y"])), (903, " ".join(long[:26]))]
    found = substring.remove_repeats(docs(spark, rows)).collect()
    expected = expected_longest(rows, 13)
    assert Counter((r["id"], r["n_words"], r["longest_repeat"]) for r in found) == expected
    assert {n for _, _, n in expected} >= {0, 26, 52}


def test_substring_dedup_of_nothing(spark):
    assert substring.remove_repeats(docs(spark, [])).count() == 0


def expected_classes(rows):
    sets, df = {}, Counter()
    for i, text in dict(rows).items():
        words = (text or "").encode().translate(near_dup.FOLD).split()
        windows = [tuple(words[p : p + 5]) for p in range(len(words) - 4)] or ([tuple(words)] if words else [])
        sets[i] = Counter(windows)
        df.update(sets[i].keys())
    n = len(rows)
    idf = {k: 1 + near_dup.IDF_SPAN * math.log((n + 1) / (c + 1)) / math.log(n + 1) for k, c in df.items()}
    weight = lambda s: sum(c * idf[k] for k, c in s.items())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and weight(sets[a] & sets[b]) >= 0.8 * weight(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("blocks", [1, 4])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr("tradeloom.llm.common.part_count", lambda df, size: blocks)
    base = [f"v{i}" for i in range(300)]
    group = [(100 + k, " ".join([*base[:k], f"edit{k}", *base[k + 1 :]])) for k in range(20, 40)]
    rows = [r for r in texts() if r[0] is not None] + group
    found = near_dup.near_duplicates(docs(spark, [*rows, (None, None)])).collect()
    got = {r["id"]: r["class_id"] for r in found}
    assert got.pop(None, None) is None and len(found) == len(got) + 1
    assert got == expected_classes(rows)


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0
    assert near_dup.near_duplicates(docs(spark, [(1, None), (2, "")])).where("id <> class_id").count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    import numpy as np

    elements = prints.multipliers(400, 5)
    a, b = elements[:300], elements[60:360]
    w = np.linspace(0.5, 3, 400).astype(np.float32)
    similar = w[60:300].sum() / w[:360].sum()
    x, y = near_dup.weighted_samples(a, w[:300], 2000), near_dup.weighted_samples(b, w[60:360], 2000)
    assert abs((x == y).mean() - similar) < 0.05


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["id"]: r["class_id"] for r in found} == {i: 1 for i in range(1, 41)} | {k: 100 for k in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing_is_exact():
    import numpy as np

    values = np.sort(prints.multipliers(1000, 9))
    assert (prints.unpack64(prints.pack64(values)) == values).all()
    starts = prints.bucket_starts(values, 7)
    assert starts[0] == 0 and starts[-1] == 1000
