"""Language ID: unigrams of pieces, with all segmentations of a text summed.

The pieces are a fixed public vocabulary.  Each language has a probability for
every piece; a word's probability is the sum over all ways to write it as
pieces, by the forward algorithm over its lattice, and a text's the product
over its words.  The probabilities are learnt by expectation maximisation
(forward-backward) on a bounded sample: at most ``SAMPLE_DOCS`` training
documents of each language, those of smallest hashed id.  Prediction scores
every word of every whole text; each distinct word of a task is scored once.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.llm.prints import mix

SAMPLE_DOCS = 400
UNDETERMINED = "und"
WORD_START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
# Sums over longer words than this are taken in logarithms.
PART = 32
# Places of the lattices of longer words that are looked at together.
PLACES = 1 << 18
EM_ROUNDS = 4
# Added to the expected count of every piece, and of the unknown character.
SMOOTHING = 0.05
# Distinct words a task remembers; then it starts afresh.
REMEMBERED = 200_000
ROWS = 768
BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A vocabulary that finds many substrings at once: prints of the pieces by length."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.longest = max(map(len, texts), default=1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, self.longest + 1):
            ids = np.array([i for i, t in enumerate(texts, 1) if len(t) == n], np.int64)
            own = [texts[i - 1] for i in ids]
            prints = np.zeros(len(ids), np.uint64)
            for column in code_points(own, n).T:
                prints = prints * BASE + column
            prints = mix(prints)
            order = np.argsort(prints)
            self.by_length[n] = prints[order], ids[order]

    def __len__(self) -> int:
        return len(self.texts)

    def find(self, n: int, prints: np.ndarray) -> np.ndarray:
        """Number of the piece of n characters with each print, or 0."""
        known, ids = self.by_length[n]
        if not len(known):
            return np.zeros(len(prints), np.int64)
        at = np.minimum(np.searchsorted(known, prints), len(known) - 1)
        return np.where(known[at] == prints, ids[at], 0)


def code_points(texts: list[str], width: int) -> np.ndarray:
    """Code points, one text a row, padded with zeros."""
    raw = "".join([t.ljust(width, "\0") for t in texts]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(-1, width).astype(np.uint64)


class Lattice:
    """All pieces at all places of many words; piece 0 is an unknown character."""

    def __init__(self, words: list[str], pieces: Pieces):
        parts = [WORD_START + word for word in words]
        self.longest = pieces.longest
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.steps = int(self.lengths.max(initial=0))
        points = code_points(parts, self.steps)
        prints = np.zeros_like(points)
        found = []
        for n in range(1, min(pieces.longest, self.steps) + 1):
            places = self.steps - n + 1
            prints = prints[:, :places] * BASE + points[:, n - 1 :]
            at, starts = np.nonzero(np.arange(places) + n <= self.lengths[:, None])
            ids = pieces.find(n, mix(prints[at, starts]))
            if n > 1:
                hit = ids > 0
                at, starts, ids = at[hit], starts[hit], ids[hit]
            found.append((at, starts, starts + n, ids))
        at, starts, ends, ids = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        order = np.argsort(ends * len(parts) + at, kind="stable")
        self.at, self.starts, self.ends, self.ids = at[order], starts[order], ends[order], ids[order]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Summed probability up to each place; p is by piece and language."""
        alpha = np.zeros((len(self.lengths), self.steps + 1, p.shape[1]))
        alpha[:, 0] = 1
        cuts = np.searchsorted(self.ends, np.arange(1, self.steps + 2))
        for end in range(1, self.steps + 1):
            own = slice(cuts[end - 1], cuts[end])
            if own.start == own.stop:
                continue
            at = self.at[own]
            terms = alpha[at, self.starts[own]] * p[self.ids[own]]
            heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            alpha[at[heads], end] = np.add.reduceat(terms, heads, axis=0)
        return alpha

    def log_forward(self, p: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of the sums up to the last ``columns`` places, by place modulo ``columns``, and up to the end."""
        log_p = np.log(p)
        alpha = np.full((len(self.lengths), columns, p.shape[1]), -np.inf)
        alpha[:, 0] = 0
        whole = np.zeros((len(self.lengths), p.shape[1]))
        cuts = np.searchsorted(self.ends, np.arange(1, self.steps + 2))
        for end in range(1, self.steps + 1):
            own = slice(cuts[end - 1], cuts[end])
            at = self.at[own]
            terms = alpha[at, self.starts[own] % columns] + log_p[self.ids[own]]
            heads, sums = log_sums(at, terms)
            alpha[:, end % columns] = -np.inf
            alpha[heads, end % columns] = sums
            last = self.lengths == end
            whole[last] = alpha[last, end % columns]
        return alpha, whole

    def log10_words(self, p: np.ndarray) -> np.ndarray:
        """log10 probability of each word by language."""
        if self.steps > PART:
            return self.log_forward(p, self.longest + 1)[1] / np.log(10)
        alpha = self.forward(p)
        return np.log10(alpha[np.arange(len(self.lengths)), self.lengths])

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words that occur ``counts`` times."""
        rows = np.arange(len(self.lengths))
        by_start = np.lexsort((self.at, -self.starts))
        at, starts, ends, ids = self.at[by_start], self.starts[by_start], self.ends[by_start], self.ids[by_start]
        cuts = np.searchsorted(-starts, -np.arange(self.steps, -2, -1), side="left")
        in_logs = self.steps > PART
        if in_logs:
            alpha, z = (x[..., 0] for x in self.log_forward(p[:, None], self.steps + 1))
            beta, log_p = np.full_like(alpha, -np.inf), np.log(p)
            beta[rows, self.lengths] = 0
        else:
            alpha = self.forward(p[:, None])[:, :, 0]
            beta = np.zeros_like(alpha)
            beta[rows, self.lengths] = 1
            z = alpha[rows, self.lengths]
        for i, start in enumerate(range(self.steps, -1, -1)):
            own = slice(cuts[i], cuts[i + 1])
            if own.start < own.stop:
                if in_logs:
                    heads, sums = log_sums(at[own], (beta[at[own], ends[own]] + log_p[ids[own]])[:, None])
                    beta[heads, start] = sums[:, 0]
                else:
                    terms = beta[at[own], ends[own]] * p[ids[own]]
                    beta[:, start] += np.bincount(at[own], terms, len(beta))
        if in_logs:
            use = np.exp(alpha[self.at, self.starts] + log_p[self.ids] + beta[self.at, self.ends] - z[self.at])
        else:
            use = alpha[self.at, self.starts] * p[self.ids] * beta[self.at, self.ends] / z[self.at]
        return np.bincount(self.ids, use * counts[self.at], len(p))


def log_sums(at: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of the sorted ``at``, and for each the logarithm of the sum of its exponentiated terms."""
    heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    most = np.maximum.reduceat(terms, heads, axis=0)
    sizes = np.diff(np.concatenate((heads, [len(at)])))
    return at[heads], most + np.log(np.add.reduceat(np.exp(terms - np.repeat(most, sizes, axis=0)), heads, axis=0))


def batches_of(words: list[str]) -> list[np.ndarray]:
    """Which words to look at together: all short ones, and longer ones of like length."""
    lengths = np.array([len(w) + len(WORD_START) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    n_short = int((lengths <= PART).sum())
    out, start = [order[:n_short]] if n_short else [], n_short
    while start < len(order):
        end = start + 1
        while end < len(order) and lengths[order[end]] * (end + 1 - start) <= PLACES and lengths[order[end]] <= 2 * lengths[order[start]]:
            end += 1
        out.append(order[start:end])
        start = end
    return out


class Model:
    """Piece probabilities by language."""

    def __init__(self, pieces: Pieces, languages: list[str], p: np.ndarray):
        self.pieces, self.languages, self.p = pieces, languages, p


def load_pieces(path: str) -> Pieces:
    """Lower-cased pieces of letters of a sentencepiece vocabulary, numbered from 1."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=path)
    texts = {processor.id_to_piece(i).lower() for i in range(processor.get_piece_size()) if not processor.is_control(i)}
    return Pieces(sorted(t for t in texts if t.lstrip(WORD_START).isalpha() or t == WORD_START))


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _count_words(batches):
    for batch in batches:
        counts = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.update((lang, w) for w in words_of(text or "") if any(map(str.isalpha, w)))
        if counts:
            langs, words = zip(*counts, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(langs, pa.string()), "word": pa.array(words, pa.string()), "n": pa.array(counts.values(), pa.int64())}
            )


def train(docs: DataFrame, training: Column, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows that ``training`` marks and that have a language."""
    rows = docs.where(training & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages, pieces = sorted(sizes), load_pieces(path)
    if not languages:
        return Model(pieces, [], np.empty((len(pieces) + 1, 0)))
    # First about twice the bound by hashed id, so that the ranking sees few rows whatever the table's size.
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    limit = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, 2.0 * SAMPLE_DOCS / n))) for k, n in sizes.items()])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("share", "id", "text"))
    sample = rows.withColumn("share", share).where(F.col("share") <= limit).withColumn("rank", rank).where(f"rank <= {SAMPLE_DOCS}")
    counted = sample.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    by_lang: dict[str, dict[str, int]] = {k: {} for k in languages}
    for row in counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toLocalIterator():
        by_lang[row["lang"]][row["word"]] = row["n"]
    p = np.empty((len(pieces) + 1, len(languages)))
    for k, language in enumerate(languages):
        found = by_lang[language]
        words, counts = list(found), np.array(list(found.values()), np.float64)
        lattices = [(Lattice([words[i] for i in batch], pieces), counts[batch]) for batch in batches_of(words)]
        own = np.full(len(p), 1 / len(p))
        for _ in range(EM_ROUNDS if found else 0):
            uses = sum(lattice.expected(own, times) for lattice, times in lattices) + SMOOTHING
            own = uses / uses.sum()
        p[:, k] = own
    return Model(pieces, languages, p)


class Scorer:
    """Scores words by language and remembers them."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.logs = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        new = words - self.rows.keys()
        if len(self.rows) + len(new) > REMEMBERED:
            self.rows, self.logs, new = {}, self.logs[:0], words
        spelled = [w for w in new if any(map(str.isalpha, w))]
        if spelled:
            parts = []
            for start in range(0, len(spelled), 20_000):
                part = spelled[start : start + 20_000]
                logs = np.empty((len(part), len(self.model.languages)))
                for batch in batches_of(part):
                    logs[batch] = Lattice([part[i] for i in batch], self.model.pieces).log10_words(self.model.p)
                parts.append(logs)
            at = len(self.logs)
            self.logs = np.concatenate([self.logs, *parts])
            self.rows.update(zip(spelled, range(at, at + len(spelled)), strict=True))
        for word in new - self.rows.keys():
            self.rows[word] = -1  # no letter

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [words_of(t) for t in texts]
        self.learn(set().union(*split))
        sizes = [len(w) for w in split]
        rows = np.fromiter((self.rows[w] for own in split for w in own), np.int64, sum(sizes))
        doc = np.repeat(np.arange(len(texts)), sizes)[rows >= 0]
        rows = rows[rows >= 0]
        n, languages = len(texts), self.model.languages
        any_word = np.bincount(doc, minlength=n) > 0
        totals = np.stack([np.bincount(doc, self.logs[rows, k], n) for k in range(len(languages))], axis=1) if languages else None
        out = []
        for i in range(n):
            if totals is None or not any_word[i]:
                out.append((UNDETERMINED, 0.0))
                continue
            best = int(np.argmax(totals[i]))  # ties: the first in the alphabet
            out.append((languages[best], float(1 / np.sum(10.0 ** np.maximum(totals[i] - totals[i][best], -300)))))
        return out


def _predict(shared):
    def predict(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = scorer.predict([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                    names=["id", "lang_pred", "score"],
                )

    return predict


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, lang_pred and score, the posterior of that language (equal priors).

    Null texts and texts without a letter are ``und`` with score 0, as are all
    when nothing was learnt.  Repeated rows repeat; only id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict(shared), "id long, lang_pred string, score double")
