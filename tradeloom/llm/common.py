"""Helpers shared by the operators: sizes, shared tables, grouping of documents into blocks."""

from __future__ import annotations

import gc
import math
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.operators.joins import input_bytes
from tradeloom.session import shared_dir

# Compressed input per block; a block's words, hashes and order take about
# 30 times this in one Python worker.  Raise it (64 MB) beyond some TB.
BLOCK_BYTES = 4 * 1024 * 1024
UNKNOWN_SIZE = 1 << 50


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have: ``name``, underlined as often as needed."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_of(df: DataFrame) -> int | None:
    """Bytes of the files a frame reads, or None where the plan does not know."""
    size = input_bytes(df)
    return None if size is None or size >= UNKNOWN_SIZE else size


def part_count(df: DataFrame, bytes_each: int) -> int:
    """Parts of ``bytes_each`` that the input of ``df`` makes."""
    size = size_of(df)
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(size / bytes_each))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back.

    Cuts the lineage: lost executors cost a re-read.  The files go when the
    driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'spark-warehouse/shared').rstrip('/')}/tradeloom-{uuid.uuid4().hex}/{name}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path.getParent())
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that nothing refers to any more.

    Its context cleaner does so once the driver's collector has found their
    plans; events still on their way to listeners hold a plan a moment longer,
    so it is asked twice.
    """
    gc.collect()
    for pause in (1.0, 0.5):
        time.sleep(pause)
        spark._jvm.System.gc()


def crc_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the key written as text, modulo ``buckets``; null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets


def sha256_utf8(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def row_bucket(docs: DataFrame, buckets: int) -> Column:
    """A hash of the whole row, modulo ``buckets``."""
    return F.pmod(F.xxhash64(*docs.columns), F.lit(buckets))


def in_any_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Add ``block``, a hash of the row, where the order of ids does not matter; exchange by it."""
    n = part_count(docs, block_bytes)
    return docs.withColumn("block", row_bucket(docs, n).cast("int")).repartition(n, "block"), n


def in_blocks(docs: DataFrame, id_col: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Add ``block``: ranges of ids with about equally many rows, in id order; exchange by it.

    Range limits come from one pass over the id column.  Rows without an id are
    spread over all blocks by a hash of the row.  The number of blocks follows
    the size of the input.
    """
    n = part_count(docs, block_bytes)
    spread = row_bucket(docs, n)
    if n > 1:
        fractions = [i / n for i in range(1, n)]
        found = docs.agg(F.percentile_approx(id_col, fractions, max(10_000, 20 * n)).alias("at")).first()["at"]
        limits = sorted(set(found or []))
    else:
        limits = []
    if limits:
        steps = 1 << (len(limits)).bit_length() - 1
        padded = F.array(*[F.lit(x).cast("long") for x in limits + [2**63 - 1] * (2 * steps - 1 - len(limits))])
        strides = F.array(*[F.lit(steps >> i) for i in range(steps.bit_length())])
        # Binary search: count the limits at or below the id.
        block = F.aggregate(
            strides,
            F.lit(0),
            lambda at, step: F.when(F.element_at(padded, at + step) <= F.col(id_col), at + step).otherwise(at),
        )
        block = F.when(F.col(id_col).isNotNull(), block).otherwise(spread)
    else:
        block = F.when(F.col(id_col).isNotNull(), 0).otherwise(spread)
    return docs.withColumn("block", block.cast("int")).repartition(n, "block"), n
