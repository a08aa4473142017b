"""Scorers that stand in for a hosted classifier: trained on labelled rows, or any function over batches of text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = 1 << 16


def train(labelled: DataFrame, label: str, text: str = "text", features: int = FEATURES) -> PipelineModel:
    """Logistic regression over hashed words. The model is one vector of ``features`` weights, whatever the corpus.

    The hashed words are kept between the passes of the optimiser; nothing else is.
    """
    words = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features, binary=True),
    ]).fit(labelled)
    prepared = words.transform(labelled.select(text, F.col(label).cast("double").alias("_label"))) \
        .select("_tf", "_label").persist()
    try:
        classifier = LogisticRegression(featuresCol="_tf", labelCol="_label", probabilityCol="_probability",
                                        rawPredictionCol="_raw", predictionCol="_prediction",
                                        regParam=0.01, maxIter=20).fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel(stages=[*words.stages, classifier])


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``score``, the probability of the label."""
    scored = model.transform(df).withColumn("score", vector_to_array("_probability")[1])
    return scored.drop("_words", "_tf", "_raw", "_probability", "_prediction")


def score_with(df: DataFrame, load: Callable[[], Callable[[pd.Series], pd.Series]], text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` from a user's own model. ``load`` runs once per task; the model then gets batches of texts, with None for a
    null text."""
    @F.pandas_udf("double")
    def scorer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield model(batch)

    return df.withColumn(score, scorer(F.col(text)))


def moderation_verdicts(scored: DataFrame, key: str, category: str, threshold: float = 0.5) -> DataFrame:
    """Scores as a verdict table for the moderation rules."""
    return scored.select(
        F.col(key), F.lit(7).alias("rule"), F.lit(0).alias("chunk_no"), F.lit(None).cast("string").alias("label"),
        F.col("score").alias("confidence"), F.lit(None).cast("boolean").alias("attack"),
        F.create_map(F.lit(category), F.col("score") >= threshold).alias("categories"))
