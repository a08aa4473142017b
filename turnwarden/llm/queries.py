"""Registered queries of the operators, each over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwarden.llm import alignment, fingerprints, licenses, minhash, mixing, mixpacking, packing, passages, pieces, quality, suffixes, warc, whitening
from turnwarden.llm.text import read
from turnwarden.sources.shared import new_folder

QUERIES: dict = {}
ORACLE: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return quality.apply_rules(docs).drop("text")


_BASE, _FAILED = quality.rules_sql()
_STOPS = ", ".join(f"'{w}'" for w in sorted({w for x in quality.STOP_WORDS for w in (x, x.capitalize(), x.upper())}))
ORACLE["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT rn, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rn, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT rn, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY rn
), lines AS (
  SELECT rn, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(w, lambda x: x IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN lines USING (rn) LEFT JOIN covered USING (rn)
)
SELECT *, ({_BASE}) AS base_failed, {_FAILED} AS failed, {_FAILED} = '' AS kept FROM m
"""


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return licenses.digest(licenses.scan(docs)).drop("text")


@query
def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents").select("doc_id", "source", "text"))


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write(read(spark, folder, "pages").select("page_id", "url", "html"), path)
    back = warc.read_warc(spark, path, ["response", "revisit"])
    return back.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        F.coalesce(F.length("payload").cast("long"), F.col("payload_length")).alias("payload_bytes"),
        F.coalesce(warc.base32(F.sha1("payload")), F.substring("payload_digest", 6, 32)).alias("payload_digest"),
        "record_type", warc.page_number(F.col("refers_to")).alias("refers_to"))


ORACLE["op8_warc"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
), d AS (
  SELECT *, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{warc.BASE32}', CAST(1 +
         ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file; ``LLM_TOKENIZERS`` names another folder."""
    return os.path.join(os.environ.get("LLM_TOKENIZERS", "/opt/tokenizers"), name)


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    shared = pieces.share(spark, tokenizer("piece_bpe_32k.model"))
    docs = pieces.encode(read(spark, folder, "documents").select("doc_id", "text"), shared)
    back = pieces.decoder(shared)(F.col("ids"))
    return docs.withColumn("round_trip", back == pieces.plain(F.col("text"))).drop("text")


@query
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op5_token_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "packed")
    packing.write(read(spark, folder, "documents"), path, packing.share(spark, tokenizer("byte_bpe_50k.tiktoken")))
    return spark.read.schema(packing.SCHEMA).parquet(path)


@query
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.groups(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op7_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.removed(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("_doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.near_passages(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixpacking.packed(read(spark, folder, "documents"), mixpacking.share(spark, tokenizer("byte_bpe_50k.json")))
    return mixpacking.pieces(mixpacking.compressed(found, "mixpacked"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.Whitening(read(spark, folder, "embeddings")).long()


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    shared = alignment.share(spark, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    return alignment.aligned(read(spark, folder, "documents"), shared)
