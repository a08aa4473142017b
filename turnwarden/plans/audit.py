"""Audit tables of screened turns, their integrity, and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.text import percent
from turnwarden.operators.decisions import events_long

TURN_COLUMNS = ["turn_id", "ts", "session_id", "user_id", "run_id", "verdict", "latency_ms", "input", "output", "tools"]
TURN_REQUIRED = ["turn_id", "ts", "verdict"]
EVENT_REQUIRED = ["turn_id", "number", "name", "action"]


# ---------------------------------------------------------------------------------------------- the two tables

def turns_table(df: DataFrame, ts: str = "ts", keep_raw: str | None = None) -> DataFrame:
    """One audit row per turn: time to the second, texts cut to their stored length, tools as a JSON list.

    The input logged is the screened text, in which personal data is already masked; ``keep_raw`` names a column to
    log instead. Missing columns are logged as NULL.
    """
    def given(name: str, kind: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)
    return df.select(
        "turn_id", F.date_trunc("second", F.col(ts)).cast("timestamp_ntz").alias("ts"),
        given("session_id", "string").alias("session_id"), given("user_id", "string").alias("user_id"),
        given("run_id", "string").alias("run_id"), "verdict", given("latency_ms", "long").alias("latency_ms"),
        F.substring(keep_raw or "text", 1, fixed.STORED_INPUT_CHARS).alias("input"),
        F.substring(given("output", "string"), 1, fixed.STORED_OUTPUT_CHARS).alias("output"),
        F.to_json(given("tools", "array<string>")).alias("tools"))


def events_table(df: DataFrame) -> DataFrame:
    """One audit row per decision, in firing order."""
    return events_long(df, "turn_id").withColumn("detail", F.substring("detail", 1, fixed.STORED_DETAIL_CHARS))


def integrity_report(turns: DataFrame, events: DataFrame) -> DataFrame:
    """(check, violations): required columns that are NULL, and events whose turn is not logged."""
    checks = [turns.agg(*[F.count_if(F.col(c).isNull()).alias(f"turns_{c}") for c in TURN_REQUIRED]),
              events.agg(*[F.count_if(F.col(c).isNull()).alias(f"events_{c}") for c in EVENT_REQUIRED]),
              events.filter("turn_id is not null").join(turns.select("turn_id"), "turn_id", "left_anti")
              .agg(F.count("*").alias("events_orphans"))]
    tall = [c.unpivot([], c.columns, "check", "violations") for c in checks]
    return (tall[0].unionByName(tall[1]).unionByName(tall[2])
            .withColumn("check", F.regexp_replace("check", "^(turns|events)_", "$1.")))


def stage_log(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """Long log of what came in and went out, contents cut to 200 characters; only answers carry tools."""
    def rows(df: DataFrame, stage: str) -> DataFrame:
        columns = ["ts", F.lit(stage).alias("stage"), "run_id",
                   F.substring("text", 1, fixed.STAGE_LOG_CHARS).alias("content")]
        return df.select(*columns, *(["tools"] if stage == "output" else []))
    return rows(turns, "input").unionByName(rows(answers, "output"), allowMissingColumns=True)


# ---------------------------------------------------------------------------------------------- questions

def recent_turns(turns: DataFrame, events: DataFrame, limit: int = 10) -> DataFrame:
    """The last turns with what fired in each. Only the chosen turns' events are read out and joined."""
    chosen = turns.orderBy(F.col("turn_id").desc()).limit(limit)
    mine = events.join(F.broadcast(chosen.select("turn_id")), "turn_id", "left_semi")
    label = F.concat(F.lit("#"), F.col("number").cast("string"), F.lit(" "), F.col("action"))
    fired = mine.groupBy("turn_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", label.alias("l")))), lambda e: e["l"]), ", ").alias("fired"))
    return chosen.join(F.broadcast(fired), "turn_id", "left").orderBy(F.col("turn_id").desc())


def verdict_counts(turns: DataFrame) -> DataFrame:
    """(verdict, n, share): turns per verdict and whole percent of all turns."""
    counts = turns.groupBy("verdict").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(1)))
    return counts.withColumn("share", percent(F.col("n") / total))


def firing_counts(events: DataFrame, subtotals: bool = False) -> DataFrame:
    """Events per rule and action, most frequent first; ``subtotals`` adds rows per rule and for all."""
    keys = ["number", "name", "action"]
    grouped = events.rollup(*keys) if subtotals else events.groupBy(*keys)
    return grouped.agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "number", "action")


def turn_event_dump(turns: DataFrame, events: DataFrame, limit: int = 20) -> DataFrame:
    """Turns with their events, newest turn first, ``limit`` rows.

    The rows shown come from the newest ``limit`` turns, so only those are joined.
    """
    newest = turns.select("turn_id", "user_id", "verdict").orderBy(F.col("turn_id").desc()).limit(limit)
    mine = events.select("turn_id", "seq", "number", "action", "detail") \
        .join(F.broadcast(newest.select("turn_id")), "turn_id", "left_semi")
    return (newest.join(mine, "turn_id", "left").orderBy(F.col("turn_id").desc(), "seq").limit(limit))


def rule_catalogue(rules: DataFrame, events: DataFrame) -> DataFrame:
    """Every rule with the number of its events; rules that never fired show 0."""
    counts = events.groupBy("number").agg(F.count("*").alias("_n"))
    return (rules.join(F.broadcast(counts), "number", "left")
            .select("number", "name", "stage", F.coalesce("_n", F.lit(0)).alias("n")))


def latency_by_verdict(turns: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Turns, mean and percentiles of the latency per verdict, from mergeable sketches."""
    p = F.percentile_approx("latency_ms", [0.5, 0.95, 0.99], accuracy)
    return (turns.groupBy("verdict").agg(F.count("*").alias("n"), F.avg("latency_ms").alias("mean_ms"), p.alias("_p"))
            .select("verdict", "n", F.round("mean_ms", 3).alias("mean_ms"), F.col("_p")[0].alias("p50"),
                    F.col("_p")[1].alias("p95"), F.col("_p")[2].alias("p99")))
