"""The permutation index against all inner products, and the prefix trie against a plain dictionary."""

import hashlib
import math
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import permutation, prefix_trie
from tradeloom.llm.common import crc_bucket

VECTORS = "vec_id long, embedding array<float>, label int, key string, part int, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], VECTORS)


def found(df, every=20, **options):
    rows = permutation.neighbours(df, F.col("id") % every == 0, **options).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    return out


def brute(rows, every=20, k=20):
    """Rows have different ids."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q is not None and q % every == 0:
            near = [(-float((w * v).sum()), i is None, i) for i, w in good if i != q and len(w) == len(v)]
            out[q] = [(n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(near, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def test_small_table_is_searched_in_full(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(100)]
    rows += [(200, None), (220, []), (240, [0.0] * 8), (260, [1.0, float("nan")] + [0.0] * 6), (280, [float("inf")] + [1.0] * 7)]
    rows += [(300, [None] + [1.0] * 7), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (322, [-0.0, 3.0]), (None, rows[5][1])]
    same = [(i, rows[3][1]) for i in range(400, 460)]  # ties: the smaller ids win
    got, want = found(vectors(spark, rows + same)), brute(rows + same)
    assert got.keys() == want.keys()
    for q, answers in want.items():
        assert [x[:2] for x in got[q]] == [x[:2] for x in answers], q
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in answers], rtol=0, atol=1e-12)


def test_repeated_rows_and_ids(spark):
    a, b, c = [1.0, 0.0], [0.5, 0.5], [0.0, 1.0]
    got = found(vectors(spark, [(0, a), (0, a), (0, b), (1, c), (1, c), (2, a)]), k=5)
    # Id 0 has two vectors: each is a query and finds the other; equal rows are one.
    assert sorted(x[1] for x in got[0]) == [0, 0, 1, 1, 2, 2]
    assert not found(vectors(spark, []))


@pytest.mark.parametrize("copies", [0, 1500])
def test_recall_in_many_blocks(spark, copies):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((10, 32))
    data = centres[rng.integers(0, 10, 4000)] + rng.standard_normal((4000, 32))
    data[:copies] = data[0] + 0.01 * rng.standard_normal((copies, 32))  # a group of near copies
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    options = {"pivots": 256, "prefix": 64, "least": 100, "block_rows": 1000, "block_queries": 64}
    got, want = found(vectors(spark, rows), **options), brute(rows)
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in answers}) for q, answers in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(len(got[q]) == 20 for q in want)


def test_agreement_is_footrule():
    rng = np.random.default_rng(3)
    k, orders = 6, np.array([rng.permutation(20)[:6] for _ in range(30)], np.uint16)
    files = permutation.InvertedFiles(orders)
    for q in orders:
        place = lambda p, x: list(x).index(p) if p in x else k
        footrule = [sum(abs(place(p, q) - place(p, x)) for p in range(20)) for x in orders]
        assert (k * (k + 1) - 2 * files.agreement(q)).tolist() == footrule


TURNS = "conv_id long, turn long, role string, text string, path string, key string, shard int"


def dictionary_trie(rows, hosted=False):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in convs.items()}
    full = convs
    if hosted:
        full = {}
        for c, t in convs.items():
            h = crc32(str(c).encode()) % 6
            full[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + t[h:]
    nodes = {}
    for c, t in full.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        inner = {p[:-1] for p in below if p}
        ends = ",".join(str(c) for c in sorted(members) if len(full[c]) == len(path))
        out.append(
            (
                min(members),
                len(path),
                min(nodes[path[:-1]]) if path else None,
                len(members),
                sum(len(p) == len(path) + 1 for p in below),
                sum(p not in inner for p in below),
                sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def trie_rows(spark, rows, hosted=False):
    df = spark.createDataFrame([(*r, "p", "k", 1) for r in rows], TURNS)
    c = F.col("conv_id")
    options = {"hosted": crc_bucket(c, 6), "host": c - c % 100} if hosted else {}
    got = prefix_trie.prefix_trie(df, **options).collect()
    return sorted(map(tuple, got), key=repr)


def random_turns(seed, convs, longest=6, words=3):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-50, 4 * convs), convs):
        for turn in range(rnd.randrange(1, longest)):
            rows.append((c, turn or None, rnd.choice(["user", "assistant", None]), rnd.choice(["", None, "a", "é\U0001f600", "long " * 9][: words + 1])))
    return rows


@pytest.mark.parametrize("hosted", [False, True])
@pytest.mark.parametrize("parts", [1, 23])
def test_trie_equals_a_dictionary(spark, hosted, parts):
    rows = random_turns(parts, 300)
    rows += [(9000 + i, t, "user", "same") for i in range(60) for t in range(5)]  # copies
    rows += [(9999, t, "user", f"turn {t % 7}") for t in range(700)] + [(None, 1, "user", "x")]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert trie_rows(spark, rows, hosted) == dictionary_trie(rows, hosted)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_trie_edges(spark, monkeypatch):
    assert trie_rows(spark, []) == [] == trie_rows(spark, [(None, 1, "a", "b")])
    monkeypatch.setattr(prefix_trie, "PIECE", 3)  # conversations and lists of ids in many pieces
    # Equal rows are turns of their own; a conversation may lose all its turns.
    turnless = next(c for c in range(100, 200) if crc32(str(c).encode()) % 6 >= 2 and c % 100)
    rows = [(1, 0, "user", "x")] * 7 + [(turnless, 0, "user", "y"), (turnless, 1, "user", "y")]
    rows += [(300 + i, 0, "user", "x" * 100_000) for i in range(8)]
    for hosted in (False, True):
        assert trie_rows(spark, rows, hosted) == dictionary_trie(rows, hosted)


def test_findclose():
    rnd = random.Random(5)
    for n in (1, 2, 63, 64, 65, 3000):
        depth = [0]
        for _ in range(n - 1):
            depth.append(rnd.randint(max(0, depth[-1] - rnd.choice([0, 1, 40])), depth[-1] + 1))
        opens, signs = prefix_trie.parentheses(np.array(depth))
        stack, close = [], {}
        for at, sign in enumerate(signs):
            if sign == 1:
                stack.append(at)
            else:
                close[stack.pop()] = at
        assert prefix_trie.Parentheses(signs).findclose(opens).tolist() == [close[o] for o in opens.tolist()]
    chain = np.arange(5000)
    assert prefix_trie.subtree_sizes(chain).tolist() == list(range(5000, 0, -1))
