"""Lookup tables joined to requests: knowledge base, medications, records, articles.

The tables are dimensions of any size. Keys are joined; "topic is a substring of the query" goes through a dictionary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.links import host, host_suffixes
from turnwarden.functions.text import trim_space
from turnwarden.operators import matching
from turnwarden.operators.dictionary import DIGEST, Dictionary, join_back


def kb_match(queries: DataFrame, kb: DataFrame, query: str = "text") -> DataFrame:
    """Add ``kb_result``: every topic that is a substring of the lower-cased query, in knowledge-base order.

    An entry without a topic or a text is none, an empty topic is in every query, and a null query holds nothing.
    """
    entries = kb.filter("text is not null and topic is not null").select(
        "ord", F.col("topic").alias("term"), F.concat(F.lit("["), F.col("topic"), F.lit("] "), F.col("text")).alias("shown"))
    lowered = F.lower(F.col(query))
    entries, table = matching.held(entries)
    if table is not None:
        return queries.withColumn("kb_result", F.coalesce(matching.shown_in(queries, table, lowered, "\n"), F.lit(fixed.KB_MISS)))
    entry = F.struct("ord", F.col("shown").alias("t"), "term")
    found = Dictionary(entries).found(queries, lowered).groupBy(*DIGEST).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(entry)), lambda e: e["t"]), "\n").alias("_hits"))
    return join_back(queries, lowered, found).withColumn("kb_result", F.coalesce("_hits", F.lit(fixed.KB_MISS))).drop("_hits")


def medication_lookup(requests: DataFrame, kb: DataFrame, medication: str = "medication") -> DataFrame:
    """Add ``medication_info``: the entry of exactly this topic, trimmed and in any case."""
    dim = kb.select(F.col("topic").alias("_key"), F.col("text").alias("_text"))
    joined = requests.join(dim, trim_space(F.lower(F.col(medication))) == F.col("_key"), "left")
    miss = F.concat(F.lit("No AcmeHealth monograph for '"), F.col(medication),
                    F.lit("'. Always follow your prescriber's instructions."))
    return joined.withColumn("medication_info", F.coalesce("_text", miss)).drop("_key", "_text")


def record_lookup(requests: DataFrame, records: DataFrame, patient_id: str = "patient_id") -> DataFrame:
    """Add ``record``: the record with this id, trimmed and in any case."""
    dim = records.select(F.col("patient_id").alias("_key"), F.col("text").alias("_text"))
    joined = requests.join(dim, F.upper(trim_space(F.col(patient_id))) == F.col("_key"), "left")
    miss = F.concat(F.lit("No record for "), F.col(patient_id), F.lit("."))
    return joined.withColumn("record", F.coalesce("_text", miss)).drop("_key", "_text")


def with_trust(df: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """Add ``trusted`` by a join of every suffix of the link's host with an allow-list table of any size. Trust belongs to
    the host, so rows that share a key are judged by their own links."""
    asked = host(F.col(url))
    suffixes = (df.select(asked.alias("_host")).distinct().select("_host", F.explode(host_suffixes(F.col("_host"))).alias("_domain"))
                .join(domains.select(F.col("domain").alias("_domain")).distinct(), "_domain", "left_semi")
                .select("_host").distinct())
    return df.join(suffixes, asked == F.col("_host"), "left").withColumn("trusted", F.col("_host").isNotNull()).drop("_host")


def article_lookup(requests: DataFrame, domains: DataFrame, articles: DataFrame, url: str = "url") -> DataFrame:
    """Add ``article``: refused for untrusted links, else the first article whose domain is a substring of the link."""
    df = with_trust(requests, domains, url)
    entries = articles.filter("text is not null").select("ord", F.col("domain").alias("term"), F.col("text").alias("_text"))
    first = Dictionary(entries).found(df.filter("trusted"), F.col(url)).groupBy(*DIGEST).agg(F.min(F.struct("ord", "_text")).alias("_first"))
    refused = F.concat(F.lit("Refused: "), F.col(url), F.lit(" is not on the trusted-domain list."))
    return join_back(df, F.col(url), first).withColumn("article", F.when(~F.col("trusted"), refused).otherwise(
        F.coalesce("_first._text", F.lit(fixed.ARTICLE_MISS)))).drop("_first")
