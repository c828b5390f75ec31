"""The operators as queries over whole tables, with digests of their results, and SQL where it can tell the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.llm import bpe, chat, decontaminate, language, near_dup, permutation, phrases, ppm, prefix_trie, quality, secret_scan, substring, warc
from tradeloom.llm.common import crc_bucket, sha256_utf8, table

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many of its words and which items of the benchmark it holds."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        decontaminate.digest_of(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: what reading its WARC record back gives."""
    read = warc.round_trip(table(spark, sf_dir, "pages")).where("last")
    return read.select(
        F.col("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the smallest id of its class of near-duplicates."""
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts, and verdicts of the base and of the labelled lines."""
    docs = table(spark, sf_dir, "documents")
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, crf).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "content_share",
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: digests of its token ids and of the text decoded from them."""
    found = bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))
    return found.select(
        F.col("id").alias("doc_id"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256_utf8(F.col("decoded")).alias("decoded_sha256"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: predicted language; learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = language.train(docs, ~held_out, tokenizer_path(PIECES))
    found = language.predicted(docs, model)
    return found.select(
        F.col("id").alias("doc_id"), (crc_bucket(F.col("id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many words repeat an earlier document, and a digest of the others."""
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), kept=sha256_utf8)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept_text").alias("kept_sha256"), "longest_repeat")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: digests of what reading the formatted turns back gives."""
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    read = chat.read_back(chat.formatted(chat.text_parts(messages.unionByName(extra))))
    return read.withColumnRenamed("conv", "conv_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts and spans of secrets."""
    found = secret_scan.scanned(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", sha256_utf8(F.col("base_spans")).alias("base_sha256"), "spans"
    )


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: unigram base and log10 probability under prediction by partial matching."""
    found = ppm.scored(table(spark, sf_dir, "documents"), crc_bucket(F.col("doc_id"), 10) != 0)
    return found.withColumnRenamed("id", "doc_id")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector whose id is divisible by 20: its 20 nearest by inner product."""
    found = permutation.neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language its phrases of 2 to 5 words, best first."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per prefix of rebuilt conversations: who begins so, and what sharing its turns saves."""
    conv = F.col("conv_id")
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), hosted=crc_bucket(conv, 6), host=conv - conv % 100)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": pipeline,
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_quality": op4_quality,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat": op8_chat,
    "op9_secrets": op9_secrets,
    "op10_lm_score": op10_lm_score,
    "op11_neighbours": op11_neighbours,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Words of every document with their places, and all windows of the items.
OP1_SQL = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("text")}, '{WORDS}') AS words FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({LOWERED.format("text")}, '{WORDS}') AS words FROM benchmark
), win AS (
  SELECT DISTINCT item_id, words[i : least(i + 9, len(words))] AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM item WHERE len(words) > 0)
), lengths AS (SELECT DISTINCT len(win) AS n FROM win),
place AS (
  SELECT doc_id, words[i : i + n - 1] AS win, i, n
  FROM (SELECT doc_id, words, n, unnest(range(1, greatest(len(words) - n + 2, 1))) AS i FROM doc, lengths)
), hit AS (
  SELECT doc_id, i, n, item_id FROM place JOIN win USING (win)
), per_doc AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN per_doc USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP2_SQL = """
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), narrow AS (
  SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM page
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS response FROM narrow
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> response THEN response END AS refers_to
FROM grouped
"""

OP7_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 12], ' ')) AS win
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) AS i FROM doc)
), first AS (
  SELECT win, min(doc_id) AS first FROM win GROUP BY win
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS w FROM win JOIN first USING (win) WHERE first < doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY w) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS w FROM doc)
  ANTI JOIN gone USING (doc_id, w) GROUP BY doc_id
), level AS (
  SELECT doc_id, i, win, 13 AS width FROM win
  WHERE win IN (SELECT win FROM win GROUP BY win HAVING min(doc_id) < max(doc_id))
  UNION ALL
  SELECT doc_id, i, win, width FROM (
    SELECT *, min(doc_id) OVER (PARTITION BY win) < max(doc_id) OVER (PARTITION BY win) AS repeated FROM (
      SELECT a.doc_id, a.i, md5(a.win || b.win) AS win, 2 * a.width AS width
      FROM level a JOIN level b ON a.doc_id = b.doc_id AND b.i = a.i + a.width
    )
  ) WHERE repeated
), longest AS (SELECT doc_id, max(width) AS longest FROM level GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(longest, 0) AS BIGINT) AS longest_repeat
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

ESCAPES = r"\\|</?s>|\[/?ROLE\]|\[/?INST\]|<image>|<audio>|<document>"

OP8_SQL = f"""
WITH message AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(length('<s>[ROLE][/ROLE][INST][/INST]</s>') + length(role) + length(text)
    + len(regexp_extract_all(role, '{ESCAPES}')) + len(regexp_extract_all(text, '{ESCAPES}'))) AS BIGINT) AS formatted_chars
FROM message GROUP BY conv_id
"""

#: All windows of up to five words; a phrase's parts are looked up among them.
OP12_SQL = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED.format("text")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), size AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
phrase AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
  FROM place, range(1, 6) t(size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT lang, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM phrase WHERE size > 1
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r, n,
    (1000::HUGEINT * c.f::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM cut c JOIN size USING (lang)
  JOIN phrase l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN phrase r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 :], ' ')
), weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), longer AS (
  SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT DISTINCT lang, w, f FROM cut), range(1, 5) s(i), range(2, 5) t(size)
  WHERE i + size - 1 <= len(w) AND size < len(w) GROUP BY ALL
), kept AS (
  SELECT s.* FROM weakest s LEFT JOIN longer g USING (lang, phrase) WHERE nth = 1 AND (g.f IS NULL OR 100 * g.f < 100 * s.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

#: The bits of an id's decimal digits, shifted through the reversed polynomial of crc32.
CRC32 = """xor(list_reduce(
  list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: list_transform(range(8), lambda i: CAST((ascii(c) >> CAST(i AS INTEGER)) & 1 AS BIGINT))))),
  lambda s, b: xor(s >> 1, 3988292384 * (xor(s, b) & 1))), 4294967295)"""

#: A prefix is named by the digests of its turns; a node's ancestors are the prefixes of its smallest member.
OP13_SQL = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS d,
    md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, conv_id - conv_id % 100 AS host, {CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)
), mixed AS (
  SELECT c.conv_id, o.d, t, chars FROM conv c JOIN own o ON o.conv_id = c.host AND o.d <= c.h
  UNION ALL SELECT c.conv_id, o.d, t, chars FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.d > c.h
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY d) AS depth, t, chars FROM mixed
), member AS (
  SELECT conv_id, depth, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix, chars FROM placed
  UNION ALL SELECT conv_id, 0, '', 0 FROM conv
), sized AS (
  SELECT *, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM member
), node AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM sized GROUP BY depth, prefix
), linked AS (
  SELECT n.*, p.prefix AS parent, p.conv_id AS parent_conv_id
  FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1 : 32 * (n.depth - 1)]
), children AS (
  SELECT depth - 1 AS depth, parent AS prefix, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), leafy AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (depth, prefix)
), below AS (
  SELECT m.depth, m.prefix, CAST(sum((l.n_convs - 1) * l.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE l.n_children = 0) AS n_leaves
  FROM leafy l JOIN member m ON m.conv_id = l.conv_id AND m.depth <= l.depth GROUP BY m.depth, m.prefix
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM leafy JOIN below USING (depth, prefix)
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op8_chat": OP8_SQL,
    "op12_collocations": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
