"""Quality rules: counts over whole texts, and lines labelled by a linear-chain CRF.

A conditional random field with two states, content and boilerplate, reads each
line as a set of yes-no features.  It is fitted by maximum conditional
likelihood on all lines of a bounded sample of labelled documents (at most
``TRAIN_DOCS``, the ones with the smallest hashed id): the lines of a good
document count as content, those of a bad one as boilerplate.  Viterbi decoding then labels every line of every whole text, and
the share of a document's words in content lines decides.
"""

from __future__ import annotations

import re
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.prints import concat, mix, runs, window_prints, word_prints

TRAIN_DOCS = 2000
MIN_SHARE = 0.5
MIN_WORDS, REPEAT_WIDTH, MAX_REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
SIGNS = b"#*$%&|<>{}[]\\^~_=+@!;"
DIGITS = b"0123456789"
NOTICE = re.compile(rb"cookie|copyright|licen[cs]e|https?://|www\.|subscribe|click|all rights", re.I)
N_FEATURES = 12
# Padded lines that are fitted together.
CELLS = 1 << 17
# Rows that are counted together.
ROWS = 256


def line_mask(line: bytes, own: list[bytes], repeated: bool, nearby: int) -> int:
    """The features of a line, its words being ``own``, as bits."""
    n, words = len(line), len(own)
    signs = n - len(line.translate(None, SIGNS))
    digits = n - len(line.translate(None, DIGITS))
    return (
        (words >= 4)
        | (words >= 15) << 1
        | (20 * signs >= n) << 2
        | (8 * signs >= n) << 3
        | line.isupper() << 4
        | (b"!!" in line) << 5
        | (2 * line.count(b"|") >= words > 1) << 6
        | repeated << 7
        | (NOTICE.search(line) is not None) << 8
        | (5 * digits >= n) << 9
        | (nearby >= 15) << 10
        | (3 * sum(map(eq, own, own[1:])) >= words > 1) << 11
    )


def lines_of(text: bytes) -> tuple[list[list[bytes]], list[int], int]:
    """Words and features of each line that has a word, and how many lines repeat an earlier one."""
    words, masks, seen, repeats, before = [], [], set(), 0, 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        repeated = line in seen
        seen.add(line)
        repeats += repeated
        masks.append(line_mask(line, own, repeated, before))
        words.append(own)
        before = len(own)
    return words, masks, repeats


class Crf:
    """Weights of a two-state linear chain: 0 is boilerplate, 1 content."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray):
        self.emission, self.transition = emission, transition
        bits = (np.arange(1 << N_FEATURES)[:, None] >> np.arange(N_FEATURES)) & 1
        scores = bits @ emission[:-1] + emission[-1]
        #: By features: how much likelier content is than boilerplate.
        self.lean = (scores[:, 1] - scores[:, 0]).tolist()

    def decode(self, masks: list[int]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to content."""
        (t00, t01), (t10, t11) = self.transition.tolist()
        lean, back = self.lean, []
        low, high = 0.0, lean[masks[0]] if masks else 0.0
        for mask in masks[1:]:
            from_low, from_high = low + t00, high + t10
            to_low = from_high >= from_low
            a = from_high if to_low else from_low
            from_low, from_high = low + t01, high + t11
            to_high = from_high >= from_low
            low, high = a, (from_high if to_high else from_low) + lean[mask]
            back.append((to_low, to_high))
        state = high >= low
        labels = [int(state)] * bool(masks)
        for step in reversed(back):
            state = step[state]
            labels.append(int(state))
        return labels[::-1]


def fit(sequences: list[list[int]], labels: list[int], rounds: int = 60, penalty: float = 1e-3) -> Crf:
    """Maximum conditional likelihood by gradient ascent (Adam), from forward-backward expectations.

    With no sequences of one of the two labels every line is content.
    """
    if len(set(labels)) < 2:
        emission = np.zeros((N_FEATURES + 1, 2))
        emission[-1, 1] = 1.0
        return Crf(emission, np.zeros((2, 2)))
    lengths = np.array([len(s) for s in sequences])
    # Documents weigh the same, whatever their length; labels are as frequent as in the sample.
    weight = 1 / (len(labels) * lengths)
    batches = [_Batch([sequences[i] for i in own], np.array(labels)[own], weight[own]) for own in _by_length(lengths)]
    theta = np.zeros((N_FEATURES + 3, 2))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        gradient = sum(batch.gradient(theta) for batch in batches) - penalty * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        theta += 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    # Scores enter decoding as content over boilerplate.
    return Crf(theta[:-2], theta[-2:])


def _by_length(lengths: np.ndarray) -> list[np.ndarray]:
    """Sequences of like length together, about ``CELLS`` padded lines a batch, so that one long text does not pad all."""
    out = []
    order = np.argsort(lengths, kind="stable")
    classes = np.maximum(np.ceil(np.log2(lengths[order])), 6)  # up to 64 lines are one class
    for c in np.unique(classes):
        own = order[classes == c]
        step = max(1, CELLS // int(lengths[own].max()))
        out += [own[start : start + step] for start in range(0, len(own), step)]
    return out


class _Batch:
    """Labelled sequences as padded matrices."""

    def __init__(self, sequences: list[list[int]], y: np.ndarray, weight: np.ndarray):
        lengths = np.array([len(s) for s in sequences])
        steps = int(lengths.max())
        masks = np.zeros((len(sequences), steps), np.int64)
        for row, own in zip(masks, sequences, strict=True):
            row[: len(own)] = own
        self.inside = np.arange(steps) < lengths[:, None]
        x = np.concatenate([(masks[..., None] >> np.arange(N_FEATURES)) & 1, np.ones((*masks.shape, 1), np.int64)], axis=2)
        self.x = (x * self.inside[..., None]).astype(np.float32)
        self.y, self.weight, self.steps = y, weight, steps

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        x, y, inside, weight, steps = self.x, self.y, self.inside, self.weight, self.steps
        pairs = inside[:, 1:]
        emission, transition = theta[:-2], theta[-2:]
        e = x @ emission
        forward, backward = np.empty(e.shape), np.zeros(e.shape)
        forward[:, 0] = e[:, 0]
        for t in range(1, steps):
            step = np.logaddexp(forward[:, t - 1, 0, None] + transition[0], forward[:, t - 1, 1, None] + transition[1])
            forward[:, t] = np.where(inside[:, t, None], step + e[:, t], forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            own = backward[:, t + 1] + e[:, t + 1]
            step = np.logaddexp(own[:, 0, None] + transition[:, 0], own[:, 1, None] + transition[:, 1])
            backward[:, t] = np.where(inside[:, t + 1, None], step, 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        expected = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
        observed = (y[:, None, None] == np.arange(2)) * inside[..., None]
        gradient = np.zeros_like(theta)
        gradient[:-2] = np.einsum("dtf,dts,d->fs", x, observed - expected, weight)
        joint = np.exp(
            forward[:, :-1, :, None]
            + transition
            + (e + backward)[:, 1:, None, :]
            - total[:, None, None, None]
        ) * pairs[..., None, None]
        gradient[-2:] = -np.einsum("dtij,d->ij", joint, weight)
        same = (pairs.sum(axis=1) * weight * np.array([y == 0, y == 1])).sum(axis=1)
        gradient[-2:] += np.diag(same)
        return gradient


def _sample_lines(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        masks = [np.array(lines_of(t or b"")[1], np.uint16).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("quality"), pa.array(masks, pa.binary())], names=["id", "quality", "masks"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Crf:
    """Fit the CRF on all lines of at most ``TRAIN_DOCS`` labelled rows (quality 1 or 0), also where ids repeat."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("quality").isin(0, 1)).orderBy(F.xxhash64("id"), "id", "quality").limit(TRAIN_DOCS)
    # At most TRAIN_DOCS rows of two numbers; as many rows of line masks reach the driver.
    sample = rows.join(F.broadcast(known), "id").mapInArrow(_sample_lines, "id long, quality int, masks binary")
    sample = sample.orderBy(F.xxhash64("id"), "id", "quality", "masks").limit(TRAIN_DOCS)
    found = sorted((r["id"], r["quality"], bytes(r["masks"])) for r in sample.collect() if r["masks"])
    return fit([np.frombuffer(x[2], np.uint16).tolist() for x in found], [x[1] for x in found])


def _repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text: words in windows of REPEAT_WIDTH words that the text has twice or more."""
    sizes = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(words)), sizes)
    windows = window_prints(concat([word_prints(w) for w in words], np.uint64), REPEAT_WIDTH)
    own = doc[: len(windows)]
    at = np.flatnonzero(np.arange(len(windows)) + REPEAT_WIDTH <= np.cumsum(sizes)[own])
    keyed = windows[at] ^ mix(own[at].astype(np.uint64))
    order = np.argsort(keyed)
    heads = runs(keyed[order])
    times = np.diff(np.concatenate((heads, [len(order)])))
    again = at[order[np.repeat(times, times) > 1]]
    change = np.zeros(len(doc) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT_WIDTH, -1)
    return np.bincount(doc, np.cumsum(change)[:-1] > 0, len(words)).astype(np.int64)


def _judge(crf: Crf, min_share: float):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "content_words")

    def judge(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                counts: dict[str, list] = {n: [] for n in names}
                labels, words = [], []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    text = text or b""
                    lines, masks, repeats = lines_of(text)
                    marks = crf.decode(masks)
                    own = [w for line in lines for w in line]
                    joined = b"".join(own)
                    counts["n_words"].append(len(own))
                    counts["word_chars"].append(len(joined.decode()))
                    counts["n_symbols"].append(len(joined) - len(joined.translate(None, SYMBOLS)))
                    counts["n_dup_lines"].append(repeats)
                    counts["content_words"].append(sum(len(line) for line, mark in zip(lines, marks, strict=True) if mark))
                    labels.append("".join("BC"[m] for m in marks))
                    words.append(own)
                n_words, again = np.array(counts["n_words"], np.int64), _repeated_words(words)
                failed = (n_words < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n_words)
                share = np.array(counts["content_words"]) / np.maximum(n_words, 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        **{n: pa.array(counts[n], pa.int64()) for n in names},
                        "n_repeat_words": pa.array(again, pa.int64()),
                        "base_failed": pa.array(failed),
                        "content_share": pa.array(share, pa.float64()),
                        "kept": pa.array(~failed & (share >= min_share)),
                        "line_labels": pa.array(labels, pa.string()),
                    }
                )

    return judge


JUDGED = (
    "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, content_words long, "
    "n_repeat_words long, base_failed boolean, content_share double, kept boolean, line_labels string"
)


def judged(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """Per row of ``docs``: counts, base verdict, the labels of its lines with a word (C or B), and the verdict.

    Words are runs of anything but ASCII white space.  Null and wordless texts
    have no words and fail the base.  Repeated rows repeat; other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_judge(crf, min_share), JUDGED)


def _keep(crf: Crf, min_share: float):
    def keep(batches):
        for batch in batches:
            two = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], names=["id", "text"])
            kept = [x for found in _judge(crf, min_share)([two]) for x in found.column("kept").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return keep


def kept_rows(docs: DataFrame, crf: Crf, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``text`` the rules keep; nothing is shuffled."""
    return docs.mapInArrow(_keep(crf, min_share), docs.schema)
