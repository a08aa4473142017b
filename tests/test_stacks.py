"""Properties of whole stacks, and streams against batch."""

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import output_rules as out
from turnwarden.operators import verdict_rules as ver
from turnwarden.operators.rate_limit import rate_limit
from turnwarden.plans import audit as au
from turnwarden.plans import screening as scr
from turnwarden.queries.common import ANSWERS, PROMPTS, turns
from turnwarden.queries.composed import independent, OVERLAP
from turnwarden.sources.shared import new_folder
from turnwarden.sources.turns import EVENT_SCHEMA, read_table, stream_table
from turnwarden.streaming.rate_limit import rate_limit_stream
from turnwarden.streaming.run import drain
from turnwarden.streaming.screening import audit_batch, read_audit, screen_stream

SMALL = "/root/testdata/sf0.001"


def test_stack_on_the_prompts(spark):
    df = spark.createDataFrame([(k, t, "patient_01") for k, t in PROMPTS], "turn_id long, text string, user_id string") \
        .withColumn("ts", F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, turn_id * 2)"))
    said = {3: F.when(F.col("turn_id") == 2, "OFF_TOPIC").otherwise("ON_TOPIC"),
            16: F.when(F.col("turn_id") == 7, "YES").otherwise("NO"), 7: F.lit(None).cast("string"),
            18: F.when(F.col("turn_id") == 8, "jailbreak").otherwise("none")}
    judged = df.select("turn_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), label.alias("label")) for n, label in said.items()])).alias("v")).select(
        "turn_id", "v.rule", "v.label", F.lit(0).alias("chunk_no"), F.lit(0.9).alias("confidence"),
        ((F.col("v.rule") == 18) & (F.col("turn_id") == 8)).alias("attack"),
        F.create_map(F.lit("violence"), F.col("turn_id") == 17).alias("categories"))
    rows = {r.turn_id: r for r in scr.screen_input(df, judged).collect()}
    expected = {0: 1, 1: 2, 2: 3, 3: 4, 4: None, 5: None, 6: 16, 7: 16, 8: 18, 9: None, 10: 19, 11: 20, 13: 22, 14: 22, 15: 23,
                16: None, 17: 7, 18: 2, 19: None}
    assert {k: rows[k].blocked_by for k in expected} == expected
    assert rows[8].decisions[-1].detail == "jailbreak (confidence 0.90)"


def test_missing_verdicts_fail_open_or_closed(spark):
    df = spark.createDataFrame([(1, "What helps with a cold?")], "turn_id long, text string")
    assert ver.topical_screen(df).first().blocked_by is None
    assert ver.topical_screen(df, fail_closed=True).first().blocked_by == 3
    row = ver.moderation_screen(df).first()
    assert row.blocked_by == 7 and "failing closed" in row.decisions[0].detail
    assert ver.prompt_attack_screen(df).first().decisions[0].action == "skipped"


def test_chunks_are_judged_in_order(spark):
    df = spark.createDataFrame([(1, "x" * 4000)], "turn_id long, text string")

    def verdict(*chunks):
        rows = [(1, 18, n, "jailbreak", c, a, None) for n, c, a in chunks]
        v = spark.createDataFrame(rows, ver.VERDICT_SCHEMA)
        return [ver.prompt_attack_screen(df, v, any_chunk=w).first().blocked_by for w in (False, True)]
    assert verdict((0, 0.1, False), (1, 0.8, True), (2, 0.1, False)) == [18, 18]
    assert verdict((0, 0.1, False), (2, 0.9, True)) == [None, None]
    assert verdict((0, 0.9, True)) == [18, None]
    assert verdict((0, 0.6, True), (1, 0.6, True), (2, None, True)) == [18, 18]


def test_redaction_is_idempotent(spark):
    df = spark.createDataFrame([(k, t) for k, t in ANSWERS], "turn_id long, text string")
    once = scr.screen_output(df, judged=False)
    again = scr.screen_output(once.select("turn_id", "text"), judged=False)
    assert [r.text for r in again.orderBy("turn_id").collect()] == [r.text for r in once.orderBy("turn_id").collect()]
    assert again.filter(F.size("decisions") > 0).count() == 0


def test_masks_keep_length(spark):
    docs = read_table(spark, SMALL, "documents")
    masked = out.profanity_mask(docs.withColumn("before", F.length("text")))
    assert masked.filter(F.length("text") != F.col("before")).count() == 0


def test_first_blocker_agrees_with_independent_rules(spark):
    fired = independent(spark, SMALL)
    alone = {r.turn_id: r.fired[0] if r.fired else None for r in fired.select("turn_id", "fired").collect()}
    df = fired.drop("fired")
    for rule, _ in OVERLAP.values():
        df = rule(df)
    together = {r.turn_id: r.blocked_by for r in df.select("turn_id", "blocked_by").collect()}
    # Stripping and masking can only take away what a later rule saw.
    assert all(together[k] == alone[k] or together[k] is None for k in together)


def test_later_filters_do_not_multiply_the_plan(spark):
    df = scr.deterministic_input(turns(spark, SMALL)).filter("blocked_by is null").select("turn_id", F.size("decisions").alias("n"))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 400_000


def _several_files(spark, name, files):
    folder = new_folder(spark, "source")
    read_table(spark, SMALL, name).repartitionByRange(files, "event_id").sortWithinPartitions("event_id") \
        .write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_admission_over_many_batches_equals_batch(spark):
    folder = _several_files(spark, "events", 4)
    streamed = rate_limit_stream(stream_table(spark, folder, "events", EVENT_SCHEMA), "event_id", "user_id", "ts", 2, 86400)
    batch = rate_limit(read_table(spark, SMALL, "events"), "event_id", "user_id", "ts", 2, 86400)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_audit_batch_can_be_repeated(spark):
    df = screen_stream(turns(spark, SMALL))
    folder = new_folder(spark, "audit")
    handle = audit_batch(folder)
    handle(df, 0)
    handle(df, 0)
    assert read_audit(spark, folder, "turns").count() == turns(spark, SMALL).count()
    events = read_audit(spark, folder, "events")
    assert au.integrity_report(read_audit(spark, folder, "turns"), events).agg(F.sum("violations")).first()[0] == 0
    assert events.count() > 0


def test_disclaimer_ends_every_answer(spark):
    df = spark.createDataFrame([(k, t) for k, t in ANSWERS], "turn_id long, text string")
    texts = [r.text for r in scr.screen_output(df, judged=False).collect()]
    assert all("not medical advice" in t.lower() for t in texts) and texts[0].endswith(fixed.DISCLAIMER)
