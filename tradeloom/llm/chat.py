"""Chat formatting: typed content parts, flattened by a visitor into one text with ordered placeholders.

The template writes each turn as

    <s>[ROLE]role[/ROLE][INST]content[/INST]</s>

and everything that comes from a message is escaped: a backslash is doubled,
and in every control string a backslash follows the first character.  So no
control string is left inside a message, and reading the output back restores
the messages exactly.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<s>", "</s>"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
BODY, BODY_END = "[INST]", "[/INST]"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
CONTROLS = (START, END, ROLE, ROLE_END, BODY, BODY_END, *PLACEHOLDERS.values())
TO_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
ESCAPED = re.compile(r"\\(\\?)")
LEARNT_ROLE = "assistant"
# Tokens that one attachment stands for, where the part itself does not say.
TOKENS = {"image": 256, "audio": 128, "document": 512}

PARTS = "array<struct<type:string,text:string,ref:string,tokens:long>>"


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: "\\\\" if m.group() == "\\" else m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of a message in order and gathers its content, attachments and token count."""

    def __init__(self):
        self.content: list[str] = []
        self.attachments: list[dict] = []
        self.expanded_tokens = 0
        self.length = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['type']}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part["text"] or ""))

    def _attach(self, part: dict) -> None:
        kind = part["type"]
        tokens = part["tokens"] if part["tokens"] is not None else TOKENS[kind]
        self.attachments.append({"type": kind, "ref": part["ref"], "at": self.length, "tokens": tokens})
        self.expanded_tokens += tokens
        self._add(PLACEHOLDERS[kind])

    visit_image = visit_audio = visit_document = _attach

    def visit_other(self, part: dict) -> None:
        """A part of unknown or null type counts as its text."""
        self.visit_text(part)

    def _add(self, text: str) -> None:
        self.content.append(text)
        self.length += len(text)


def _format(batches):
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("formatted", "loss_start", "loss_end", "attachments", "expanded_tokens")}
        roles, parts = batch.column("role").to_pylist(), batch.column("parts").to_pylist()
        for role, own in zip(roles, parts, strict=True):
            visitor = Flattener()
            for part in own or []:
                if part is not None:
                    visitor.visit(part)
            head = START + ROLE + escape(role or "") + ROLE_END + BODY
            content = "".join(visitor.content)
            learnt = role == LEARNT_ROLE
            for attachment in visitor.attachments:
                attachment["at"] += len(head)
            out["formatted"].append(head + content + BODY_END + END)
            out["loss_start"].append(len(head) if learnt else 0)
            out["loss_end"].append(len(head) + len(content) if learnt else 0)
            out["attachments"].append(visitor.attachments)
            out["expanded_tokens"].append(visitor.expanded_tokens)
        kinds = {
            "formatted": pa.string(),
            "loss_start": pa.int64(),
            "loss_end": pa.int64(),
            "attachments": pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])),
            "expanded_tokens": pa.int64(),
        }
        yield pa.RecordBatch.from_pydict(
            {"conv": batch.column("conv"), "turn": batch.column("turn"), **{k: pa.array(out[k], t) for k, t in kinds.items()}}
        )


FORMATTED = (
    "conv long, turn long, formatted string, loss_start long, loss_end long, "
    "attachments array<struct<type:string,ref:string,at:long,tokens:long>>, expanded_tokens long"
)


def text_parts(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Messages whose content is one text: add ``parts``."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("long").alias("tokens"),
    )
    return messages.withColumn("parts", F.array(part))


def formatted(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """One row per message: conv, turn, its formatted text, the span under the loss mask, attachments, token count.

    The formatted conversation is its messages' texts by turn (equal turns:
    by text) one after another; it is kept as rows, so one long conversation
    never has to fit in one cell.  Null roles are empty, null parts nothing.
    ``attachments`` list type, reference, offset and token count in order.
    """
    rows = messages.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).alias("role"),
        F.col("parts").cast(PARTS).alias("parts"),
    )
    return rows.mapInArrow(_format, FORMATTED)


class _Digest:
    """Reads one conversation's messages back, one at a time."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.all_turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, start: int, end: int) -> None:
        """Take a message apart by its control strings and check that nothing else is there."""
        if not text.startswith(START + ROLE) or not text.endswith(BODY_END + END):
            raise ValueError(f"conversation {self.conv}: not a formatted turn")
        role, _, rest = text[len(START + ROLE) :].partition(ROLE_END + BODY)
        content = rest[: -len(BODY_END + END)]
        self.turns += 1
        self.chars += len(text)
        self.all_turns.update(f"{unescape(role)}\n{unescape(content)}\n".encode())
        if end > start or unescape(role) == LEARNT_ROLE:
            learnt = unescape(text[start:end])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode())


def _read_back(batches):
    kinds = {"conv": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}

    def batch_of(done):
        rows = [(d.conv, d.turns, d.all_turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars) for d in done]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))

    current, done = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "formatted", "loss_start", "loss_end"))
        for conv, text, start, end in zip(*columns, strict=True):
            if current is None or conv != current.conv:
                if current is not None:
                    done.append(current)
                current = _Digest(conv)
            current.read(text, start, end)
        if done:
            yield batch_of(done)
            done = []
    if current is not None:
        yield batch_of([current])


def read_back(rows: DataFrame) -> DataFrame:
    """Per conversation, from formatted rows: turns and text under the loss mask, unescaped, as digests.

    A conversation streams through one task in turn order, since a digest is
    sequential; it is never held whole.
    """
    ordered = (
        rows.select("conv", "turn", "formatted", "loss_start", "loss_end")
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "formatted")
    )
    return ordered.mapInArrow(
        _read_back, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
