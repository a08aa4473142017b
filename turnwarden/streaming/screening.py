"""Screening, audit and firing counts on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwarden.operators import verdict_rules as ver
from turnwarden.operators.language import LanguageModel
from turnwarden.plans.audit import events_table, turns_table
from turnwarden.plans.screening import InputSettings, deterministic_input, judged_input, screened_verdict
from turnwarden.sources.sinks import write_audit_batch


def screen_stream(turns: DataFrame, settings: InputSettings = InputSettings()) -> DataFrame:
    """The row-local input stack on a stream: no state, no shuffle."""
    return deterministic_input(turns, settings).withColumn("verdict", screened_verdict())


def audit_batch(folder: str):
    """``foreachBatch`` handler that writes both audit tables of a screened batch; a repeated batch replaces itself."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            write_audit_batch(turns_table(kept), events_table(kept), folder, batch_id)
        finally:
            kept.unpersist()
    return handle


def read_audit(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def firing_counts_stream(events: DataFrame, ts: str = "ts", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per rule, action and tumbling window. In update mode every batch gives the windows that changed, open ones too."""
    return (events.withWatermark(ts, late)
            .groupBy(F.window(ts, window).alias("w"), "number", "action").agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("window_start"), "number", "action", "n"))


COUNT_KEYS = ["window_start", "number", "action"]


def upsert_counts(folder: str):
    """``foreachBatch`` handler for ``firing_counts_stream`` in update mode: the rows that a batch changed, in a folder of its own."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    return handle


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts so far: of every window, rule and action the row of the newest batch."""
    rows = spark.read.parquet(folder)
    return rows.groupBy(*COUNT_KEYS).agg(F.max_by("n", "batch_id").alias("n"))


def screen_stream_judged(turns: DataFrame, replies: DataFrame, settings: InputSettings = InputSettings(skip=(26,)), language: LanguageModel | None = None,
                         patience: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """The input stack with its judged rules over a stream of turns (ts) and the stream of what the judges replied (``turn_id,
    asked_at, replied_at, rule, chunk_no, reply``).

    ``asked_at`` is the time of the turn that was asked about. Replies that come later than ``patience`` do not count: the check
    was unavailable, and the rule fails open or closed, as in batch. Replies are merged per turn, and turns joined to them, once
    the watermark has passed the turn by ``late``, which must be longer than the patience and bounds the state of both.
    Admission is a stream of its own (``rate_limit``), so rule 26 has to be skipped.
    """
    if 26 not in settings.skip:
        raise ValueError("admission depends on earlier turns; skip rule 26 and use Admission")
    in_time = replies.filter(F.col("replied_at") <= F.col("asked_at") + F.expr(f"interval {patience}")).withWatermark("asked_at", late)
    answers = ver.answer_rows(ver.parse_judgements(in_time, "turn_id", "asked_at"))
    judged = ver.verdicts_per_turn(answers, "turn_id", "asked_at", merged=True).withColumnRenamed("turn_id", "_turn")
    joined = turns.withWatermark("ts", late).join(judged, (F.col("turn_id") == F.col("_turn")) & (F.col("ts") == F.col("asked_at")), "leftOuter")
    done = judged_input(joined.drop("_turn", "asked_at"), settings, language)
    return ver.drop_verdicts(done).drop("_language", "_p").withColumn("verdict", screened_verdict())
