"""WARC archives written and read as tables of chunks.

Payloads travel as rows (record, chunk number, bytes): Spark cuts them, the
writer streams the chunks of a record into its own gzip member, and the reader
yields chunks again, each with the digest and length of the payload so far.  So
neither side holds more of a record than a chunk.

Archive files are written by tasks under names of their own; only those that a
finished task lists count, so a lost executor or a second attempt leaves
nothing but an unlisted file.
"""

from __future__ import annotations

import base64
import hashlib
import math
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tradeloom.llm.common import part_count, written
from tradeloom.session import shared_dir

CHUNK = 64 * 1024
MIN_REVISIT = 1000
# A file is closed at the first record that ends beyond this many compressed bytes.
FILE_BYTES = 64 * 1024 * 1024
# Input of one writing task.
TASK_BYTES = 16 * 1024 * 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
#: Pages carry no capture time.
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"


def records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Narrow table of what to write: id, digest, bytes, type, refers_to; one row per id and payload.

    Of payloads equal by digest and length, and of at least ``MIN_REVISIT``
    bytes, the largest id is the response.  Rows of equal id and payload are
    written each, with the same type; a null id never is the response of
    others.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    narrow = pages.select(F.col(id_col).cast("long").alias("id"), F.sha1(payload).alias("digest"), F.length(payload).cast("long").alias("bytes")).distinct()
    narrow = written(narrow, "narrow")
    # Copies pre-aggregate, so a payload of many pages sends one row per task.
    groups = narrow.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest", "bytes").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.where("n > 1").drop("n"), "groups")
    revisit = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return narrow.join(groups, ["digest", "bytes"], "left").select(
        "id",
        "digest",
        "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def chunks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows to write: the record's columns, url, chunk number, chunk; a revisit has one empty chunk."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    full = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    own = records(pages, id_col, html_col).withColumnRenamed("id", "own_id").withColumnRenamed("digest", "own_digest")
    # By id, not by digest: the copies of one page spread over all tasks.
    joined = full.join(own, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")))
    last = F.when(F.col("type") == "revisit", 0).otherwise(F.greatest(F.ceil(F.col("bytes") / CHUNK) - 1, F.lit(0)))
    numbered = joined.withColumn("chunk", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    cut = F.expr(f"IF(type = 'revisit', X'', substring(payload, chunk * {CHUNK} + 1, {CHUNK}))")
    return numbered.select("id", "url", "digest", "bytes", "type", "refers_to", "chunk", cut.alias("data"))


def _header(row: dict) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    revisit = row["type"] == "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['type']}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if row['id'] is None else row['id']}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe=chr(37) + ':/?#[]@!$&()*+,;=~')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else row['bytes'])}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID_PREFIX}{row['refers_to']}>"]
    return "\r\n".join(lines).encode() + END + http


class _File:
    """One archive file, a gzip member per record."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.path, self.records = path, 0
        self.out = system.open_output_stream(path, compression=None)

    def begin(self, header: bytes) -> None:
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.add(header)

    def add(self, data: bytes) -> None:
        self.out.write(self.member.compress(data))

    def end(self) -> None:
        self.add(END)
        self.out.write(self.member.flush())
        self.records += 1


def _absolute(folder: str) -> str:
    """A folder named without a scheme, from the driver's working folder, as pyarrow wants it."""
    return folder if ":/" in folder else os.path.abspath(folder)


def _write(folder: str, file_bytes: int):
    def write(batches) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        file, done, digest, row = None, [], None, None

        def finish() -> None:
            if row["type"] == "response" and digest.hexdigest() != row["digest"]:
                raise ValueError(f"record {row['id']}: its chunks do not make its payload")
            file.end()

        def close() -> None:
            done.append((file.path, file.records, file.out.tell()))
            file.out.close()

        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            for i in range(batch.num_rows):
                new = {name: column[i].as_py() for name, column in zip(batch.schema.names, columns, strict=True)}
                if new["chunk"] == 0:
                    if row is not None:
                        finish()
                    if file is not None and file.out.tell() >= file_bytes:
                        close()
                        file = None
                    if file is None:
                        file = _File(system, f"{base}/{uuid.uuid4().hex}.warc.gz")
                    row, digest = new, hashlib.sha1()
                    file.begin(_header(row))
                digest.update(new["data"])
                file.add(new["data"])
        if row is not None:
            finish()
            close()
        if done:
            paths, counts, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths), "records": pa.array(counts, pa.int64()), "bytes": pa.array(sizes, pa.int64())})

    return write


def write_archives(rows: DataFrame, folder: str, parts: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write chunk rows to WARC files in a shared folder; returns the written list (path, records, bytes).

    A record's chunks must be adjacent in their partition, as ``chunks`` makes
    them.  The folder is a URI that pyarrow opens (file, hdfs, s3, gs).
    """
    folder = _absolute(folder)
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    return written(rows.mapInArrow(_write(folder, file_bytes), "path string, records long, bytes long"), "list")


class _Stream:
    """The decompressed bytes of a file of gzip members, as asked for."""

    def __init__(self, source):
        self.source, self.left, self.ready, self.member = source, b"", bytearray(), None

    def _more(self) -> bool:
        raw = self.left or self.source.read(CHUNK)
        if not raw:
            return False
        if self.member is None:
            self.member = zlib.decompressobj(31)
        self.ready += self.member.decompress(raw, CHUNK)
        self.left = self.member.unconsumed_tail
        if self.member.eof:
            self.left, self.member = self.member.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and without the mark; None at the end of the file."""
        while (at := self.ready.find(mark)) < 0:
            if not self._more():
                if self.ready:
                    raise ValueError("the archive ends inside a record")
                return None
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        """Exactly n bytes."""
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def _fields(block: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in block.decode().split("\r\n")[1:] if ": " in line)


def _page(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix(ID_PREFIX)
    return int(number) if number else None


def read_records(source) -> Iterator[dict]:
    """Chunks of all records of an open archive file: ids, chunk number, bytes, and digest and length so far."""
    stream = _Stream(source)
    while (block := stream.until(END)) is not None:
        head = _fields(block)
        length = int(head["Content-Length"])
        http = stream.until(END)
        length -= len(http) + len(END)
        row = {"id": _page(head["WARC-Record-ID"]), "type": head["WARC-Type"], "refers_to": _page(head.get("WARC-Refers-To"))}
        stated = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        if row["type"] == "revisit":  # the payload is with the record it refers to
            yield row | {"chunk": 0, "data": b"", "digest": stated, "bytes": int(_fields(http)["Content-Length"]), "last": True}
            stream.take(length)
        else:
            digest, done = hashlib.sha1(), 0
            for chunk in range(max(1, math.ceil(length / CHUNK))):
                data = stream.take(min(CHUNK, length - done))
                digest.update(data)
                done += len(data)
                last = done == length
                if last and digest.hexdigest() != stated:
                    raise ValueError(f"record {row['id']}: payload digest mismatch")
                yield row | {"chunk": chunk, "data": data, "digest": digest.hexdigest(), "bytes": done, "last": last}
        if stream.take(len(END)) != END:
            raise ValueError("a record is longer than it says")


READ = "id long, type string, refers_to long, chunk int, data binary, digest string, bytes long, last boolean"
READ_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("type", pa.string()),
        ("refers_to", pa.int64()),
        ("chunk", pa.int32()),
        ("data", pa.binary()),
        ("digest", pa.string()),
        ("bytes", pa.int64()),
        ("last", pa.bool_()),
    ]
)
BATCH_BYTES = 8 * 1024 * 1024


def _read(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, name = fs.FileSystem.from_uri(path)
            with system.open_input_stream(name, compression=None) as source:
                ready, size = [], 0
                for row in read_records(source):
                    ready.append(row)
                    size += len(row["data"]) + 200
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(ready, schema=READ_ARROW)
                        ready, size = [], 0
                if ready:
                    yield pa.RecordBatch.from_pylist(ready, schema=READ_ARROW)


def read_archives(listed: DataFrame) -> DataFrame:
    """The chunk table of listed archive files (column path): one row per chunk, files in parallel.

    ``digest`` and ``bytes`` are of the payload up to the chunk's end, so the
    row marked ``last`` has those of the whole; revisits have one empty chunk
    and state those of the payload they refer to.
    """
    files = max(1, listed.count())
    return listed.select("path").repartition(files, "path").mapInArrow(_read, READ)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back as chunks.

    Null html is an empty payload, a null url an empty one.  An empty table
    makes no file.  Extra columns are not read.
    """
    spark = pages.sparkSession
    if folder is None:
        folder = _absolute(f"{shared_dir(spark, 'spark-warehouse/shared').rstrip('/')}/warc-{uuid.uuid4().hex}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    listed = write_archives(chunks(pages, id_col, url_col, html_col), folder, part_count(pages, TASK_BYTES))
    scheme = folder.split("://")[0] + "://" if "://" in folder else ""
    return read_archives(listed.withColumn("path", F.concat(F.lit(scheme), "path")))
