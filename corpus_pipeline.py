"""The stages of the training-text pipeline, in order; each works on everything its predecessor kept.

Quality rules reject documents; of near-duplicate documents one of each group stays; passages that repeat elsewhere are cut
out; sources are mixed to their target weights; what is left is encoded. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwarden.llm import minhash, mixing, pieces, quality, suffixes
from turnwarden.llm.queries import tokenizer
from turnwarden.llm.text import read
from turnwarden.sources.shared import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    return quality.keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by five-word shingles of similarity 0.8 or more."""
    return minhash.deduplicated(docs, size=5)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that lie in a string of 200 bytes with another occurrence."""
    return suffixes.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks that the mix uses, once per use."""
    return mixing.mixed(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids and their number, and whether decoding gives the text back."""
    shared = pieces.share(spark, tokenizer("piece_bpe_32k.model"))
    back = pieces.decoder(shared)(F.col("ids"))
    return pieces.encode(docs.select("doc_id", "source", "lang", "text"), shared).withColumn(
        "round_trip", back == pieces.plain(F.col("text"))).drop("text")


STAGES = [("quality_rules", quality_rules), ("minhash_near_dedup", minhash_near_dedup), ("suffix_array_dedup", suffix_array_dedup),
          ("source_mixing", source_mixing), ("sentencepiece_encoding", sentencepiece_encoding)]
#: Mixing draws blocks by hash and encoding is no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read back before the next one."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, f"stage-{name}")
    return docs
