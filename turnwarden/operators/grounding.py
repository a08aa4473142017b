"""Claims of an answer against the text it was built from, and answers against their question.

Where a judge has spoken its rows decide. Without one, a claim counts as supported when enough of its words occur in
the context of the same run. Claims and contexts meet on (run, word), so a run with very many results or claims is
spread over as many tasks as it has words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.text import tokens, trim_space
from turnwarden.operators.decisions import record, rewrite, start
from turnwarden.operators.verdict_rules import NO_ANSWER

CLAIM = r"[^.!?\n]+[.!?]*"
SHOWN_CLAIMS = 100  # the report keeps 300 characters and each further claim adds more than three


def claims(answers: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, claim_no, claim): the sentences of an answer that hold a word."""
    found = F.transform(F.regexp_extract_all(F.col(text), F.lit(CLAIM), F.lit(0)), trim_space)
    return (answers.select(key, F.posexplode(found).alias("claim_no", "claim"))
            .filter(F.col("claim").rlike(r"[\p{L}\p{N}]")))


def supported_claims(answer_claims: DataFrame, contexts: DataFrame, key: str, threshold: float = 0.6,
                     context: str = "result") -> DataFrame:
    """Add ``supported``: whether the share of a claim's words found in the key's context reaches the threshold."""
    words = answer_claims.select(key, "claim_no", F.explode(tokens(F.col("claim"))).alias("word"))
    known = contexts.select(key, F.explode(tokens(F.col(context))).alias("word")).distinct()
    share = (words.join(known.withColumn("_known", F.lit(1)), [key, "word"], "left")
             .groupBy(key, "claim_no").agg(F.count("*").alias("_n"), F.count("_known").alias("_k")))
    return (answer_claims.join(share, [key, "claim_no"])
            .withColumn("supported", F.col("_k") >= F.lit(threshold) * F.col("_n")).drop("_n", "_k"))


def grounding_check(answers: DataFrame, contexts: DataFrame, judged: DataFrame | None = None, key: str = "turn_id",
                    threshold: float = 0.6, text: str = "text", context: str = "result") -> DataFrame:
    """Replace answers with a claim the context does not support; without a context there is nothing to check.

    ``judged`` (key, claim_no, claim, supported) holds a judge's findings; an answer with a context but without a row
    there was not judged and is let through. A missing ``supported`` counts as supported.
    """
    grounded = (contexts.filter(F.col(context).isNotNull() & (F.col(context) != ""))
                .select(key).distinct().withColumn("_context", F.lit(True)))
    df = start(answers).join(grounded, key, "left")
    to_check = df.filter(F.col("_context") & (F.col(text) != ""))
    rows = supported_claims(claims(to_check, key, text), contexts, key, threshold, context) if judged is None else judged
    first = W.partitionBy(key).orderBy("claim_no")
    shown = (rows.filter(~F.coalesce("supported", F.lit(True)))
             .select(key, "claim_no", F.substring(F.lower("claim") if judged is not None else F.col("claim"), 1,
                                                  fixed.CLAIM_CHARS).alias("claim"))
             .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= SHOWN_CLAIMS)
             .groupBy(key).agg(F.array_join(F.transform(
                 F.array_sort(F.collect_list(F.struct("_n", "claim"))), lambda c: c["claim"]), " | ").alias("_bad")))
    df = df.join(shown, key, "left")
    checked: Column = F.col("_context") & (F.col(text) != "")
    if judged is not None:
        df = df.join(judged.select(key).distinct().withColumn("_judged", F.lit(True)), key, "left")
        df = record(df, 14, "RAG grounding", "skipped", F.when(
            checked & F.col("_judged").isNull(), F.lit(f"judge unavailable ({NO_ANSWER}), failing open"))).drop("_judged")
    bad = checked & F.col("_bad").isNotNull()
    df = record(df, 14, "RAG grounding", "modified", F.when(bad, F.concat(F.lit("unsupported: "), F.col("_bad"))))
    return rewrite(df, text, bad, F.lit(fixed.UNGROUNDED_REPLACEMENT)).drop("_context", "_bad")


def word_overlap(question: Column, answer: Column) -> Column:
    """Shared words as a share of the shorter side's, 0 without any."""
    q, a = tokens(question), tokens(answer)
    return F.coalesce(F.size(F.array_intersect(q, a)) / F.nullif(F.least(F.size(q), F.size(a)), F.lit(0)), F.lit(0.0))


def relevance_labels(pairs: DataFrame, min_overlap: float, question: str = "question",
                     answer: str = "answer") -> DataFrame:
    """Stand-in judge for relevance: RELEVANT when question and answer share enough words. Stays inside the row."""
    score = word_overlap(F.col(question), F.col(answer))
    return pairs.withColumn("overlap", score).withColumn(
        "label", F.when(F.col("overlap") >= min_overlap, F.lit("RELEVANT")).otherwise(F.lit("IRRELEVANT")))


def topic_labels(df: DataFrame, lexicon: list[str], text: str = "text") -> DataFrame:
    """Stand-in judge for the topic: ON_TOPIC when the text holds a word of the domain's lexicon."""
    words = F.array(*[F.lit(w) for w in lexicon])
    return df.withColumn("label", F.when(F.arrays_overlap(tokens(F.col(text)), words), F.lit("ON_TOPIC"))
                         .otherwise(F.lit("OFF_TOPIC")))
