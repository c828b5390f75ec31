"""Collocations against counts in dictionaries."""

import random
import re
from collections import Counter

import pytest

from tradeloom.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, print long, rank int"


def brute(rows, support, longest, top):
    out = []
    for lang in {lang or "und" for _, lang in rows}:
        total, count = 0, Counter()
        for text, own in rows:
            if (own or "und") != lang:
                continue
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                words = re.findall(r"[^\x20\x09]+", piece)
                total += len(words)
                for size in range(1, longest + 1):
                    count.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        found = {p: a for p, a in count.items() if a >= support and len(p) > 1}
        scored = []
        for p, a in found.items():
            if any(b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            cuts = [(1000 * a * total // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            phrase = " ".join(p)
            scored.append((-score, -a, phrase.encode(), (phrase, a, count[p[:k]], count[p[k:]], total, score)))
        out += [(lang, n + 1, *x[3]) for n, x in enumerate(sorted(scored)[:top])]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, phrases.collocations(df.repartition(3), **options).collect()))


def texts(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "of", "a\x01", "a", "Straße", "ÉTÉ", "日本", "x\xa0y", "new", "york", "city", "to\x00day"]
    weights = [30, 5, 20, 3, 3, 2, 2, 2, 2, 5, 5, 5, 1]
    joints = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "! ", " ; ", "\x85", "\x1c"]
    out = []
    for _ in range(n):
        words = rnd.choices(vocabulary, weights, k=rnd.randrange(0, 60))
        text = "".join(w + rnd.choice(joints) for w in words) + rnd.choice(["", "one passage that is the same everywhere here"])
        out.append((text, rnd.choice(["en", "en", "en", "de", None])))
    return [*out, (None, "en"), ("", None), (" \t ", "fr"), ("...", "fr")]


@pytest.mark.parametrize(("budget", "bits"), [(1 << 18, 20), (20, 20), (5, 15)])
def test_equals_dictionaries(spark, budget, bits):
    """Many groups, extended prefixes, and bitmaps so small that hashes meet."""
    rows = texts(budget) + [("hot pair " * 400, "en")] * 3
    got = found(spark, rows, support=4, top=60, budget=budget, bits=bits)
    assert got == brute(rows, 4, 5, 60)


def test_long_texts_and_small_chunks(spark, monkeypatch):
    rows = [(" ".join(f"w{i * i % 97}" + ("." if i % 13 == 0 else "") for i in range(30_000)), "en")] + texts(7, 40)
    want = brute(rows, 10, 4, 2000)
    assert found(spark, rows, support=10, longest=4, bits=20) == want
    monkeypatch.setattr(phrases, "CHUNK", 64)
    monkeypatch.setattr(phrases, "HELD", 100)
    monkeypatch.setattr(phrases, "SLICE", 3)
    assert found(spark, rows[1:], support=10, longest=4, bits=20) == brute(rows[1:], 10, 4, 2000)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None)], support=1) == []
