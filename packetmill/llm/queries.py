"""The registered queries of this subpackage, and the DuckDB statements that some of them have."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.llm import (bpe, exact_dedup, hard_negatives, html_text, jaccard, langid, mixing, quality, resample,
                            secrets, simhash, token_files, topk)
from packetmill.llm.common import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SPACE = r"[\x20\x09-\x0D]+"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(docs).drop("text")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).drop("text", "lang")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_ids(docs, table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = exact_dedup.add_fingerprint(table(spark, sf_dir, "documents")).drop("row")
    marked = exact_dedup.mark_repeats(stored(prints, "fingerprints"))
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, TOKENIZER, decode="digest").select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), 20, lambda vec_id: vec_id % 20 == 0)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).drop("html")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.write_and_read(docs, TOKENIZER, end_id=2).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, words=3, distance=2, keep_text=False)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, label=label)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "benchmark"), keep_text=False)


def _spans_sql(no: int, rule: secrets.Rule) -> str:
    """Per document the spans of one rule; list sums over the pieces give the positions."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {no} AS no, '{rule.kind}' AS kind,
         list_sum(list_transform(pieces[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS s,
         length(hits[i]) AS n
  FROM (SELECT doc_id, pieces, hits, vals, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS hits,
                     regexp_extract_all(text, '{pattern}', {rule.value}) AS vals
              FROM documents WHERE regexp_matches(text, '{pattern}')))
  WHERE length(vals[i]) >= {rule.least}"""


OP1_SQL = f"""
WITH spans AS ({" UNION ALL ".join(_spans_sql(n, r) for n, r in enumerate(secrets.RULES))}),
told AS (SELECT doc_id, no, s, concat(kind, ':', CAST(s AS BIGINT), ':', CAST(s + n AS BIGINT)) AS span FROM spans),
lists AS (
  SELECT doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, no) FILTER (no < 3) AS base, string_agg(span, ',' ORDER BY s, no) AS spans
  FROM told GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN lists USING (doc_id)
"""

OP5_SQL = rf"""
WITH prints AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM prints WINDOW same AS (PARTITION BY text_sha256)
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""

OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row_no AS anchor_no, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.row_no <> c.row_no AND len(a.e) = len(c.e)),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_no ORDER BY score DESC, vec_id) AS nth FROM scored WHERE same) WHERE nth <= 5),
windows AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_no, p.nth ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n ON p.anchor_no = n.anchor_no AND NOT n.same
       AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE place <= 5
"""

# CRC-32 by its table, which SQL derives bit by bit; the words' UTF-8 bytes come from their hexadecimal form.
OP13_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
words AS (
  SELECT true AS corpus, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT false, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
spelled AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(word) + 1),
                 lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i - 1 AS INTEGER), 2) AS BIGINT))),
    lambda c, b: xor(c // 256, steps[CAST(xor(c, b) % 256 AS INTEGER) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), crc),
counts AS (
  SELECT bucket, count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t FROM words JOIN spelled USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)
                                 / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS gain FROM counts),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN spelled USING (word) JOIN gains USING (bucket) WHERE corpus GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n // 10 THEN place END AS rank FROM placed
"""

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_bpe": op6_bpe,
    "op7_topk": op7_topk,
    "op8_html_text": op8_html_text,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_token_files": op10_token_files,
    "op11_simhash": op11_simhash,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_resampling": op13_resampling,
}
ORACLES = {
    "op1_secrets": OP1_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op7_topk": OP7_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_resampling": OP13_SQL,
}
