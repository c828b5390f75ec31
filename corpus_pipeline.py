"""A corpus pipeline of five stages; each reads what the one before has kept, written as Parquet.

Documents that the quality rules reject go, one of each class of near-duplicates
stays, documents that hold a window of a benchmark item go, secrets are masked,
and what is left becomes token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.llm import bpe, decontaminate, near_dup, quality, secret_scan
from tradeloom.llm.common import free_name, sha256_utf8, table, written
from tradeloom.llm.queries import TOKENIZER, tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep; the line labeller is fitted on the labelled rows among them."""
    return quality.kept_rows(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near-duplicates; of one id the smallest text.

    Each distinct text of an id is judged by itself, and equal rows by id and
    text are one.  Rows without id, too, leave one in each class, besides the
    one that has an id.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("doc_id IS NULL OR n > 1").isEmpty():
        gone = near_dup.near_duplicates(docs).where("id <> class_id").select(F.col("id").alias("doc_id"))
        return docs.join(written(gone, "gone"), "doc_id", "left_anti").select(docs.columns)
    key, row = free_name(docs, "near_key"), free_name(docs, "near_row")
    first = F.min(F.struct(F.lit(0).alias(key), *[c for c in docs.columns if c not in ("doc_id", "text")])).alias(row)
    # The key is written with its row, so it stays that row's.
    once = docs.groupBy("doc_id", "text").agg(first).select("doc_id", "text", f"{row}.*")
    once = written(once.withColumn(key, F.monotonically_increasing_id()), "once")
    classes = near_dup.near_duplicates(once, id_col=key).select(F.col("id").alias(key), F.col("class_id").alias(row))
    least = F.min(F.struct("doc_id", "text", key))[key].alias(key)
    members = once.select(key, "doc_id", "text").join(classes, key)
    kept = members.groupBy(row, F.col("doc_id").isNull()).agg(least).select(key)
    return once.join(written(kept, "kept"), key, "left_semi").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    hit, digest = free_name(docs, "hit_id"), free_name(docs, "hit_digest")
    found = written(found.select(F.col("id").alias(hit), F.col("digest").alias(digest)), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(hit)) & (F.md5(F.col("text").cast("binary")) == F.col(digest))
    return docs.join(found, same, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars is that of the masked text."""
    return secret_scan.masked(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: token ids (little-endian unsigned 32-bit integers), their number, and digests of both directions."""
    found = bpe.encoded(docs, tokenizer_path(TOKENIZER))
    return found.select(
        F.col("id").alias("doc_id"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256_utf8(F.col("decoded")).alias("decoded_sha256"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("bpe", tokenize),
]

#: Weighted sampling, a trained labeller and token merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
