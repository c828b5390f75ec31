"""Secret scans: patterns, and candidates confirmed by the structure they decode to.

Three base kinds are found by pattern alone.  Base64 and hex candidates, PEM
blocks and dotted tokens are decoded and parsed; only those whose nested
lengths or headers hold are reported, as further kinds:

    jwt   signed token: the header decodes to a JSON object that names an algorithm
    pem   armoured block whose body decodes to a nested-length key encoding
    der   base64 run that decodes to a nested-length key encoding
    ssh   base64 run that decodes to length-prefixed fields of a key type
    hexkey  hex run that decodes to a nested-length key encoding, but for one digit at either end

Keys have at least ``MIN_KEY_BYTES`` bytes and fill their run; lengths nest to
any depth.  A token's header begins with a brace, at the start of its run or
followed by a quote.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh", "hexkey")
RANK = {kind: i for i, kind in enumerate(KINDS)}
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Runs of at least the needed length; a shorter run has no match inside either.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# No key is shorter.
MIN_KEY_BYTES = 24
ANY_HEX = re.compile(rf"[0-9A-Fa-f]{{{2 * MIN_KEY_BYTES},}}")
# What a brace encodes to: any at the start of a run, with a quote after it anywhere.
TOKEN = re.compile(r"(?:eyJ|(?<![A-Za-z0-9_-])e[w-z0-9_-])[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----", re.A)
BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{{-(-MIN_KEY_BYTES * 4 // 3)},}}={{0,2}}")
KEY_TYPES = (b"ssh-rsa", b"ssh-ed25519", b"ssh-dss", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")


def decode64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, and start and end of the content, of a tag-length-value at ``at``."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        n = length & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        length, at = int.from_bytes(data[at : at + n]), at + n
    return (tag, at, at + length) if at + length <= end else None


def nested(data: bytes, at: int, end: int) -> int | None:
    """How many elements the range holds, nested ones included; None if a length does not fit exactly."""
    count, ends = 0, [end]
    while ends:
        if at == ends[-1]:
            ends.pop()
            continue
        element = _element(data, at, ends[-1])
        if element is None:
            return None
        tag, start, stop = element
        count += 1
        at = stop
        if tag & 0x20:
            at = start
            ends.append(stop)
    return count


def is_key_encoding(data: bytes | None) -> bool:
    """A sequence of nested lengths that fills the data and holds an integer and a key, or an algorithm."""
    if not data or len(data) < MIN_KEY_BYTES or data[0] != 0x30:
        return False
    whole = _element(data, 0, len(data))
    if whole is None or whole[2] != len(data):
        return False
    count = nested(data, whole[1], whole[2])
    if count is None or count < 2:
        return False
    first = _element(data, whole[1], whole[2])
    return first is not None and first[0] in (0x02, 0x30)


def is_wire_key(data: bytes | None) -> bool:
    """Length-prefixed fields that fill the data, the first of which names a key type."""
    if not data or len(data) < MIN_KEY_BYTES:
        return False
    at, fields = 0, 0
    while at + 4 <= len(data):
        length = int.from_bytes(data[at : at + 4])
        if not fields and data[at + 4 : at + 4 + length] not in KEY_TYPES:
            return False
        at += 4 + length
        fields += 1
    return at == len(data) and fields >= 2


def is_signed_token(text: str) -> bool:
    """The first part decodes to a JSON object with a string ``alg``, the second to any JSON value."""
    header, payload, _ = text.split(".")
    try:
        head = json.loads(decode64(header) or b"")
        json.loads(decode64(payload) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start and kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates whose structure holds."""
    found = []
    if "." in text:
        found += [(m.start(), RANK["jwt"], m.end()) for m in TOKEN.finditer(text) if is_signed_token(m.group())]
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            data = decode64(m.group(2))
            if is_key_encoding(data) or (data or b"").startswith(b"openssh-key-v1\0"):
                found.append((m.start(), RANK["pem"], m.end()))
    for m in BASE64.finditer(text):
        data = decode64(m.group())
        if is_key_encoding(data):
            found.append((m.start(), RANK["der"], m.end()))
        elif is_wire_key(data):
            found.append((m.start(), RANK["ssh"], m.end()))
    for m in ANY_HEX.finditer(text):
        start, end = m.span()
        odd = (end - start) % 2
        for a, b in ((start, end - odd), (start + 1, end - 1 + odd)):
            if is_key_encoding(bytes.fromhex(text[a:b])):
                found.append((a, RANK["hexkey"], b))
                break
    return found


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlapping ones together, replaced by ``[SECRET]``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _scan(batches):
    for batch in batches:
        out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_spans": [], "spans": [], "redacted": []}
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            spans = sorted(base + confirmed_spans(text))
            for i, kind in enumerate(BASE_KINDS):
                out[f"n_{kind}"].append(sum(s[1] == i for s in base))
            out["base_spans"].append(spelled(base))
            out["spans"].append(spelled(spans))
            out["redacted"].append(redacted(text, spans) if spans else None)
        counts = {k: pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in out.items()}
        yield pa.RecordBatch.from_pydict({"id": batch.column("id"), **counts})


SCANNED = "id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, redacted string"


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, counts of the base kinds, base_spans, all spans, and the redacted text.

    Spans are kind:start:end in code points, by start and kind, joined by
    commas; ``redacted`` is null where there is nothing to redact.  Null texts
    are empty and have no spans; texts of any length are scanned whole.
    Repeated rows repeat, an empty table gives none; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scan, SCANNED)


def _mask(batches):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).to_pylist()
        masked = [t and redacted(t, sorted(base_spans(t) + confirmed_spans(t))) for t in texts]
        columns = list(batch.columns)
        columns[at] = pa.array(masked, batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def masked(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, each secret in ``text`` replaced by ``[SECRET]``."""
    return docs.mapInArrow(_mask, docs.schema)
