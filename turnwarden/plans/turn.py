"""A whole turn as one job: input, tool calls, approvals, answer, verdict, and the rows of the audit log.

A turn that waits for a human is logged as paused; once all of its calls are decided it is resumed and logged a second time,
with what was decided as its input. Events of all stages stand in one list, in the order in which the stages run. What is
stored of an answer is what the output rules left of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import tool_rules as tool
from turnwarden.operators.decisions import DECISIONS_TYPE, event
from turnwarden.operators.language import LanguageModel
from turnwarden.plans.screening import InputSettings, block_reply, latency_ms, screen_input, screen_output
from turnwarden.sources.shared import settle

CALL_COLUMNS = ["call_id", "run_id", "seq", "user_id", "tool_name", "args", "result"]


def _stage(df: DataFrame, stage: int, resumed: Column, entry: Column) -> DataFrame:
    """Events of single calls: run, part of the turn, and their place in it."""
    return df.select("run_id", resumed.alias("resumed"), F.lit(stage).alias("stage"), "seq", "call_id", F.posexplode(entry).alias("pos", "e"))


def screen_calls(calls: DataFrame, decisions: DataFrame, users: DataFrame, permissions: DataFrame,
                 limit: int = fixed.TOOL_CALL_LIMIT) -> tuple[DataFrame, DataFrame]:
    """``runs`` (run_id, paused, resumed, summary, tools, context) and their ``events``.

    Calls beyond the limit never run. Calls that need a human wait for a decision first, the others and the approved ones go
    through permission, arguments and the scan of their result. At most ``limit`` calls of a run are gathered.
    """
    capped = tool.tool_call_cap(calls.select(*CALL_COLUMNS), limit)
    admitted = settle(capped.filter(~F.col("skipped")).drop("skipped"), "turn-calls")
    asked = tool.approval_reconcile(admitted.filter(F.col("tool_name").isin(fixed.CONFIRMED_TOOLS)), decisions, users, permissions)
    asked = settle(asked, "turn-approvals")
    waiting = asked.groupBy("run_id").agg(F.max(F.col("status") == "paused").alias("paused"))
    ready = admitted.filter(~F.col("tool_name").isin(fixed.CONFIRMED_TOOLS)).withColumn("resumed", F.lit(False)).unionByName(
        asked.filter("executes").select(*CALL_COLUMNS).withColumn("resumed", F.lit(True)))
    # An approved call runs when its run is resumed, which is when none of its calls waits any more.
    ready = ready.join(waiting, "run_id", "left").filter(~F.col("resumed") | ~F.coalesce("paused", F.lit(False))).drop("paused")
    done = settle(tool.screen_tools(ready, users, permissions), "turn-results")
    pause = F.array(event(10, "Human approval", "paused", F.concat("tool_name", F.lit(" awaiting approval"))))
    of_run = tool.tool_call_cap_events(calls, limit).select("run_id", F.lit(False).alias("resumed"), F.lit(2).alias("stage"), F.lit(0).cast("long").alias("seq"),
                                                            F.lit(0).cast("long").alias("call_id"), F.lit(0).alias("pos"), event(8, "Loop control", "blocked", F.col("detail")).alias("e"))
    decided = asked.join(waiting.filter("not paused").select("run_id"), "run_id", "left_semi")
    events = (_stage(done, 1, F.col("resumed"), F.col("decisions")).unionByName(of_run)
              .unionByName(_stage(asked, 3, F.lit(False), pause))
              .unionByName(_stage(decided, 0, F.lit(True), F.col("decisions"))))
    texts = done.filter(F.col("executed") & F.col("tool_name").isin(fixed.SOURCE_TOOLS)).groupBy("run_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "call_id", "result"))), lambda x: x["result"]), "\n").alias("context"))
    names = admitted.groupBy("run_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "call_id", "tool_name"))), lambda x: x["tool_name"]).alias("tools"))
    summary = tool.approval_summary(decided).select("run_id", F.col("input").alias("summary"))
    runs = names.join(texts, "run_id", "left").join(waiting, "run_id", "left").join(summary, "run_id", "left")
    return runs.withColumn("resumed", F.col("paused").isNotNull() & ~F.col("paused")), events


def screen_turns(turns: DataFrame, verdicts: DataFrame | None, calls: DataFrame, decisions: DataFrame, users: DataFrame, permissions: DataFrame,
                 answers: DataFrame, answer_verdicts: DataFrame | None, claims: DataFrame | None = None, language: LanguageModel | None = None,
                 settings: InputSettings = InputSettings(), outcomes: DataFrame | None = None) -> DataFrame:
    """One row per logged part of a turn: the columns of ``turns``, ``resumed``, ``verdict``, ``text`` (what is stored as input),
    ``output``, ``tools``, ``decisions`` and ``latency_ms``. ``calls`` and ``answers`` belong to turns by ``run_id`` and ``turn_id``.

    ``outcomes`` (``run_id, resumed, failed, started, finished``) is what the runtime measured: a part that failed after it came
    through the input rules is an ERROR without an answer, and a run that failed is not resumed. Without a row a part did not
    fail and its latency is not known.
    """
    screened = settle(block_reply(screen_input(turns, verdicts, language, settings)), "turn-input")
    live = screened.filter("blocked_by is null").select("run_id", "turn_id")
    runs, call_events = screen_calls(calls.join(live.select("run_id"), "run_id", "left_semi"), decisions, users, permissions)
    runs, call_events = settle(runs, "turn-runs"), settle(call_events, "turn-events")
    # Only turns that came through and do not wait are answered.
    answered = live.join(runs.select("run_id", "paused"), "run_id", "left").filter(~F.coalesce("paused", F.lit(False))).select("turn_id")
    asked = screened.select("turn_id", F.col("text").alias("question"))
    contexts = runs.filter("context <> ''").join(live, "run_id").select("turn_id", F.col("context").alias("result"))
    out = screen_output(answers.select("turn_id", "text").join(answered, "turn_id", "left_semi").join(asked, "turn_id"), answer_verdicts, contexts, claims)
    out = out.select("turn_id", F.col("text").alias("_output"), F.col("decisions").alias("_after"))
    gathered = call_events.groupBy("run_id", "resumed").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("stage", "seq", "call_id", "pos", "e"))), lambda x: x["e"]).alias("_calls"))
    none = F.array().cast(DECISIONS_TYPE)
    empty = "run_id string, resumed boolean, failed boolean, started timestamp, finished timestamp"
    if outcomes is None:
        outcomes = turns.sparkSession.createDataFrame([], empty)
    outcomes = settle(outcomes.groupBy("run_id", "resumed").agg(
        F.max(F.coalesce("failed", F.lit(False))).alias("_failed"), latency_ms(F.min("started"), F.max("finished")).alias("latency_ms")), "turn-outcomes")
    broken = outcomes.filter("not resumed and _failed").select("run_id", F.lit(True).alias("_broken"))
    parts = screened.join(runs.select("run_id", "tools", "paused", F.col("resumed").alias("_resumed"), "summary"), "run_id", "left")
    waits = F.col("paused").isNotNull()
    parts = parts.join(broken, "run_id", "left")
    parts = parts.withColumn("resumed", F.explode(F.when(F.coalesce("_resumed", F.lit(False)) & F.col("_broken").isNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    failed = F.col("blocked_by").isNull() & F.coalesce("_failed", F.lit(False))
    final = F.col("blocked_by").isNull() & (~waits | F.col("resumed")) & ~failed
    rows = parts.join(gathered, ["run_id", "resumed"], "left").join(out, "turn_id", "left").join(outcomes, ["run_id", "resumed"], "left")
    return rows.select(
        *[c for c in turns.columns if c != "text"], "resumed",
        F.when(F.col("blocked_by").isNotNull(), "BLOCKED").when(failed, "ERROR").when(final, "ALLOWED").otherwise("PAUSED").alias("verdict"), "latency_ms",
        F.when(F.col("resumed"), F.col("summary")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("blocked_by").isNotNull(), F.col("reply")).when(final, F.col("_output")).alias("output"),
        F.coalesce("tools", F.array().cast("array<string>")).alias("tools"),
        F.concat(F.when(F.col("resumed"), none).otherwise(F.col("decisions")), F.coalesce("_calls", none),
                 F.when(final, F.coalesce("_after", none)).otherwise(none)).alias("decisions"))
