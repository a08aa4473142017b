"""TF-IDF cosine of two texts: relevance of an answer to its question, and closeness of a text to a topic.

Weights of words are whole ten-thousandths, so sums do not depend on their order. Words of both sides of a pair meet on
(pair, word), where counts are summed before the shuffle; a pair of very long texts is spread over as many tasks as it has words.
Only words that both sides share enter the product; the others only lengthen their side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 10_000
#: Least cosine of an answer that addresses its question, and of a text that keeps to the topic.
RELEVANT, ON_TOPIC = 0.05, 0.02


def words(text: Column) -> Column:
    """All lower-cased words, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def fit_idf(texts: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """``word, idf`` of the words seen, and the weight of a word not seen: ln((1 + n) / (1 + documents)) + 1, scaled."""
    n = texts.count()
    counts = texts.select(F.explode(F.array_distinct(words(F.col(text)))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    weight = F.round((F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0) * SCALE).cast("long")
    import math
    return counts.select("word", weight.alias("idf")), round((math.log(1.0 + n) + 1.0) * SCALE)


def cosines(pairs: DataFrame, keys: Sequence[str], left: str, right: str, idf: tuple[DataFrame, int]) -> DataFrame:
    """``keys`` and ``cosine`` of every pair, rounded to six places; 0 where a side has no word. ``keys`` tell pairs apart."""
    weights, unseen = idf
    sides = pairs.select(*keys, F.explode(F.array(F.struct(F.lit(1).cast("long").alias("l"), F.lit(0).cast("long").alias("r"), F.col(left).alias("t")),
                                                  F.struct(F.lit(0).cast("long").alias("l"), F.lit(1).cast("long").alias("r"), F.col(right).alias("t")))).alias("s"))
    counts = sides.select(*keys, "s.l", "s.r", F.explode(words(F.col("s.t"))).alias("word")).groupBy(*keys, "word").agg(
        F.sum("l").alias("l"), F.sum("r").alias("r"))
    weighed = counts.join(weights, "word", "left").withColumn("idf", F.coalesce("idf", F.lit(unseen)).cast("decimal(20,0)"))
    square = F.col("idf") * F.col("idf")
    sums = weighed.groupBy(*keys).agg(*[F.sum((F.col(a) * F.col(b)).cast("decimal(18,0)") * square).cast("double").alias(n)
                                        for n, a, b in (("_dot", "l", "r"), ("_l", "l", "l"), ("_r", "r", "r"))])
    cosine = F.when((F.col("_l") > 0) & (F.col("_r") > 0), F.col("_dot") / F.sqrt(F.col("_l")) / F.sqrt(F.col("_r"))).otherwise(0.0)
    return pairs.select(*keys).join(sums, list(keys), "left").select(*keys, F.round(F.coalesce(cosine, F.lit(0.0)), 6).alias("cosine"))


def relevance_tfidf(pairs: DataFrame, keys: Sequence[str], idf: tuple[DataFrame, int], question: str = "question", answer: str = "answer",
                    threshold: float = RELEVANT) -> DataFrame:
    """Stand-in judge for relevance: ``keys, cosine, label``."""
    return cosines(pairs, keys, question, answer, idf).withColumn("label", F.when(F.col("cosine") >= threshold, "RELEVANT").otherwise("IRRELEVANT"))


def topical_tfidf(df: DataFrame, keys: Sequence[str], topic: str, idf: tuple[DataFrame, int], text: str = "text", threshold: float = ON_TOPIC) -> DataFrame:
    """Stand-in judge for the topic, which is described by a text: ``keys, cosine, label``."""
    return cosines(df.withColumn("_topic", F.lit(topic)), keys, text, "_topic", idf).withColumn(
        "label", F.when(F.col("cosine") >= threshold, "ON_TOPIC").otherwise("OFF_TOPIC"))
