"""The operators applied to the given tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm import (
    decontaminate,
    fingerprints,
    htmltext,
    importance,
    licenses,
    linededup,
    mixing,
    neardup,
    repair,
    simhash,
    substrings,
    toxicity,
    warc,
)
from anaquel.llm.common import documents, pages


def _sha256(text: str):
    return F.sha2(F.col(text), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(documents(spark, sf_dir), benchmark).drop("_row")


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.drop_repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256")
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(pages(spark, sf_dir)).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(pages(spark, sf_dir)).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", _sha256("kept").alias("kept_sha256")
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).documents.select(
        "doc_id", "size", "source_size", "target", "taken", "shards"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(documents(spark, sf_dir), labels)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_of_edits(documents(spark, sf_dir)).drop("only_text", "only_edited")


def op11_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).withColumn(
        "fingerprint", simhash.hexadecimal("fingerprint")
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resampled(documents(spark, sf_dir), benchmark).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair.repair(damaged, F.col("present"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_minhash_neardup": op2_minhash_neardup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_html": op4_html,
    "op5_warc": op5_warc,
    "op6_license_scan": op6_license_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_fingerprints": op10_fingerprints,
    "op11_simhash_neardup": op11_simhash_neardup,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op5_warc": r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT hex, min(page_id) AS first FROM p GROUP BY hex
), n AS (
  SELECT p.*, f.first, CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
  FROM p JOIN f USING (hex)
), d AS (
  -- base32: forty hex digits are eight groups of five, each of which makes four letters
  SELECT *, list_transform(range(0, 8), lambda g: ('0x' || substr(hex, (5 * g + 1)::INT, 5))::BIGINT) AS v
  FROM n
)
SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((v[i // 4 + 1] >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM d
""",
    "op7_line_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents
), l AS (
  SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d
), k AS (
  SELECT r, doc_id, pos, line,
    translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM l
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM k WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.r, k.doc_id, k.pos, k.line, s.k IS NOT NULL AND k.doc_id <> s.keeper AS dropped
  FROM k LEFT JOIN shared s ON k.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
""",
    "op8_mixing": r"""
WITH s AS (
  SELECT doc_id, source, substr(md5(coalesce(text, '')), 1, 16) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), d AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, digest) AS copy FROM s
), g AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), n AS (
  SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS n FROM g
), w AS (
  SELECT *, CASE n % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM n
), c AS (
  SELECT *, sum(source_size) OVER () AS total,
    sum(cap) OVER o - cap AS caps, sum(w) OVER () - sum(w) OVER o + w AS rest
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / w, n)
), f AS (
  SELECT *, cap * rest <= (total - caps) * w AS is_full FROM c
), t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
    (total - coalesce(sum(cap) FILTER (is_full) OVER (), 0))::DOUBLE * w
    / (sum(w) FILTER (NOT is_full) OVER ())::DOUBLE END AS target
  FROM f
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes
  FROM t
), b AS (
  SELECT doc_id, copy, source, size, digest,
    unnest(range(0, ((size + 63) // 64)::BIGINT)) AS block FROM d WHERE size > 0
), k AS (
  SELECT *, least(64, size - block * 64) AS words,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || digest || ':' || copy || ':' || block || ':0'), 1, 15))
      ::BIGINT AS key
  FROM b
), r AS (
  SELECT *, sum(words) OVER o - words AS before, row_number() OVER o - 1 AS rank, count(*) OVER (PARTITION BY source) AS blocks
  FROM k WINDOW o AS (PARTITION BY source ORDER BY key, doc_id, copy, block ROWS UNBOUNDED PRECEDING)
), slots AS (
  -- one per block and pass
  SELECT r.*, unnest(range(1, passes + 1 + CASE WHEN passes < 3
    AND before + words / 2.0::DOUBLE <= target - passes * source_size THEN 1 ELSE 0 END)) AS pass
  FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source
), urn AS (
  SELECT *, ('0x' || substr(md5(key || ':' || pass || ':urn0'), 1, 15))::BIGINT AS urn FROM slots
), dealt AS (
  -- the tree's leaves: runs of the urn's order
  SELECT source, ((row_number() OVER (ORDER BY urn, doc_id, copy, block, pass) - 1) * 16) // count(*) OVER () AS shard
  FROM urn
), quotas AS (
  SELECT source, shard, count(*) AS n FROM dealt GROUP BY source, shard
), runs AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY shard) AS stop FROM quotas
), taken AS (
  SELECT doc_id, copy, u.source, digest, sum(words) AS taken, count(DISTINCT shard) AS shards
  FROM urn u JOIN runs q ON u.source IS NOT DISTINCT FROM q.source
    AND (pass - 1) * blocks + rank >= stop - n AND (pass - 1) * blocks + rank < stop
  GROUP BY doc_id, copy, u.source, digest
)
SELECT d.doc_id, d.size, p.source_size, p.target, coalesce(t.taken, 0)::BIGINT AS taken,
  coalesce(t.shards, 0)::BIGINT AS shards
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN taken t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.copy = t.copy
  AND d.source IS NOT DISTINCT FROM t.source AND d.digest = t.digest
""",
}
