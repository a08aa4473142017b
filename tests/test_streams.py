"""Streams of several micro-batches against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from turnwarden.operators import language as lang
from turnwarden.operators import verdict_rules as ver
from turnwarden.operators.rate_limit import rate_limit
from turnwarden.plans import screening as scr
from turnwarden.queries import streams as q
from turnwarden.queries.common import turns
from turnwarden.sources import dimensions as dim
from turnwarden.streaming.approvals import approvals_stream
from turnwarden.streaming.rate_limit import Admission, admitted, rate_limit_stream
from turnwarden.streaming.run import drain, drain_batches, start_to_files, stateful_session
from turnwarden.streaming.screening import firing_counts_stream, read_counts, screen_stream_judged, upsert_counts

SMALL = "/root/testdata/sf0.001"


def in_batches(session, df, folder, parts):
    """A stream of one file per micro-batch; ``parts`` are the conditions that choose the rows of each."""
    import time
    for k, part in enumerate(parts):
        df.filter(part).coalesce(1).write.mode("append").parquet(f"{folder}/{k:02}")
        time.sleep(0.05)  # files are taken by age
    return session.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


@pytest.mark.parametrize("group_rows", [5_000_000, 40])
def test_admission_equals_batch(spark, tmp_path, group_rows):
    rng = random.Random(group_rows)
    rows = [(i, "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.randrange(0, 600)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, user string, s int").withColumn("ts", F.timestamp_micros(F.col("s").cast("long") * 1_000_000))
    stream = in_batches(spark, df, str(tmp_path / "in"), [f"s >= {a} and s < {a + 200}" for a in (0, 200, 400)])
    got = {r.id: r.admitted for r in rate_limit_stream(stream, "id", "user", "ts", 4, 60, group_rows=group_rows).collect()}
    assert got == {r.id: r.admitted for r in rate_limit(df, "id", "user", "ts", 4, 60).collect()} and len(got) == 300


def test_a_batch_can_run_again(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", i) for i in range(10)], "id long, user string, s int").withColumn("ts", F.timestamp_micros(F.col("s").cast("long") * 1_000_000))
    admit = Admission(str(tmp_path), "id", "user", "ts", 3, 5)
    for number, part in ((0, "s < 4"), (1, "s >= 4 and s < 7"), (1, "s >= 4 and s < 7"), (2, "s >= 7")):
        admit(df.filter(part), number)
    assert {r.id for r in admitted(spark, str(tmp_path)).filter("admitted").collect()} == {0, 1, 2, 6, 7, 8}


def test_counts_of_open_windows(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, "blocked", 600 * i) for i in range(40)], "number int, action string, s int").withColumn(
        "ts", F.timestamp_micros(F.col("s").cast("long") * 1_000_000))
    stream = in_batches(spark, df, str(tmp_path / "in"), ["s < 9000", "s >= 9000 and s < 15000", "s >= 15000"])
    drain_batches(firing_counts_stream(stream.select("number", "action", "ts")), upsert_counts(str(tmp_path / "out")), "counts", "update")
    rows = read_counts(spark, str(tmp_path / "out"))
    want = df.groupBy(F.window("ts", "1 hour").start.alias("window_start"), "number", "action").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want.collect()))


def test_approvals_over_batches(spark, tmp_path):
    own = stateful_session(spark)
    minute = lambda c: F.timestamp_micros((F.col(c).cast("long") + 30_000_000) * 60_000_000)
    calls = own.createDataFrame([(1, 0, "staff_01"), (2, 1, "guest_01"), (3, 2, "staff_01"), (4, 3, "staff_01"), (5, 4, "staff_01"), (6, 200, "staff_01"), (6, 201, "staff_01"),
                                 (None, 5, "staff_01"), (7, 6, "staff_01")],
                                "call_id long, m int, user_id string").select("call_id", minute("m").alias("asked_at"), "user_id", F.lit("book_appointment").alias("tool_name"), "m")
    said = own.createDataFrame([(1, 5, True, "yes"), (1, 6, False, "late change"), (2, 5, True, None), (3, 90, True, "too late"), (4, 7, None, "no flag"), (5, 9, False, "no"),
                                (5, 9, True, "tie"), (9, 3, True, "no such call"), (7, 1, True, "before it was asked")],
                               "call_id long, m int, approved boolean, note string").select("call_id", minute("m").alias("decided_at"), "approved", "note", "m")
    pending = in_batches(own, calls, str(tmp_path / "calls"), ["m < 4 or m is null", "m >= 4 and m < 100", "m >= 100"])
    decisions = in_batches(own, said, str(tmp_path / "said"), ["m in (5, 9)", "m <> 5 and m <> 9"])
    rows = drain(approvals_stream(pending.drop("m"), decisions.drop("m"), dim.users(own), dim.role_permissions(own)), "approvals", spark).collect()
    assert sorted([(r.call_id, r.status, r.note) for r in rows], key=str) == sorted([
        (1, "paused", None), (1, "approved", "yes"), (2, "auto-rejected", None), (3, "paused", None), (3, "expired", None), (4, "paused", None), (4, "rejected", "no flag"),
        (5, "paused", None), (5, "rejected", "no"), (6, "paused", None), (7, "paused", None), (7, "expired", None)], key=str)


def test_judged_stream_equals_batch(spark, tmp_path):
    t = turns(spark, SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    last = t.limit(1).withColumns({"turn_id": F.lit(-1).cast("long"), "ts": F.timestamp_seconds(F.lit(4_000_000_000))})
    given, replies = t.unionByName(last), q.replies(t.unionByName(last))
    model = lang.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    streams = [in_batches(spark, df, str(tmp_path / name), parts) for name, df, parts in (
        ("turns", given, ["turn_id % 2 = 0", "turn_id % 2 <> 0 and turn_id >= 0", "turn_id < 0"]),
        ("replies", replies, ["rule <> 7 and turn_id >= 0", "rule = 7 and turn_id >= 0", "turn_id < 0"]))]
    settings = scr.InputSettings(skip=(26,))
    # Replies of a later file still count: the watermark of the turns waits for them.
    streamed = drain(screen_stream_judged(*streams, settings=settings, language=model, late="20000 days").select("turn_id", "blocked_by", "verdict", "text", "decisions"), "judged")
    in_time = replies.filter("replied_at <= asked_at + interval 10 minutes")
    batch = scr.screen_input(given, ver.parse_judgements(in_time), model, settings).withColumn("verdict", scr.screened_verdict()).filter("turn_id >= 0")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.select(*streamed.columns).collect())) and streamed.count() == t.count()
    with pytest.raises(ValueError):
        screen_stream_judged(*streams, settings=scr.InputSettings())


def test_both_forms_of_the_language_model_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    odd = spark.createDataFrame([(9001, "en", None), (9002, "en", ""), (9003, None, "unlabelled"), (9004, "xx", "日本語のテキスト 🙂"), (9005, "en", "123 !?"), (9006, "en", "a" * 70000)], docs.schema)
    model = lang.fit(docs.unionByName(odd))
    joined = lang.LanguageModel(model.languages, model.grams, None)
    asked = docs.unionByName(odd)
    rows = [{r.doc_id: (r.language, round(r.probability, 9)) for r in lang.score(asked, m, "doc_id", F.col("text")).collect()} for m in (model, joined)]
    assert rows[0] == rows[1] and not {9001, 9002} & rows[0].keys() and rows[0][9004][0] == "xx"
    twice = [sorted(map(str, lang.with_language(asked.unionByName(asked), m, F.col("text")).select("doc_id", "_language", F.round("_p", 9)).collect())) for m in (model, joined)]
    assert twice[0] == twice[1]
    plan = lang.score(docs, model, "doc_id", F.col("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_crisis_rule_without_its_judge(spark):
    df = spark.createDataFrame([(1, "I want to die"), (2, "a quiet day")], "turn_id long, text string")
    verdicts = spark.createDataFrame([(2, 16, 0, "YES", None, None, None)], ver.VERDICT_SCHEMA)
    for judge, blocked in ((True, {1: 16, 2: 16}), (False, {1: 16, 2: 7})):
        rows = scr.screen_input(df, verdicts, settings=scr.InputSettings(skip=(26, 22), crisis_judge=judge)).collect()
        assert {r.turn_id: r.blocked_by for r in rows} == blocked


def test_approvals_share_states(spark, tmp_path):
    own = stateful_session(spark)
    minute = lambda c: F.timestamp_micros((F.col(c).cast("long") + 30_000_000) * 60_000_000)
    ids = own.range(300).withColumn("m", (F.col("id") / 3).cast("int"))
    calls = ids.select(F.col("id").alias("call_id"), minute("m").alias("asked_at"), F.lit("staff_01").alias("user_id"), F.lit("book_appointment").alias("tool_name"), "m")
    said = ids.filter("id % 3 < 2").withColumn("m", F.col("m") + F.when(F.col("id") % 3 == 0, 5).otherwise(31)).select(
        F.col("id").alias("call_id"), minute("m").alias("decided_at"), (F.col("id") % 2 == 0).alias("approved"), F.lit(None).cast("string").alias("note"), "m")
    # A decision comes with its call, before it or after it; it is in time or too late, or there is none.
    pending = in_batches(own, calls, str(tmp_path / "calls"), ["m < 30", "m >= 30 and m < 60", "m >= 60"])
    decisions = in_batches(own, said, str(tmp_path / "said"), ["m < 50", "m >= 50 and m < 70", "m >= 70"])
    stream = approvals_stream(pending.drop("m"), decisions.drop("m"), dim.users(own), dim.role_permissions(own), 1800, "100 minutes", buckets=4)
    done = start_to_files(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    done.awaitTermination()
    got = sorted((r.call_id, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    end = 99 + 31 - 100
    want = [(i, "paused") for i in range(300)] + [(i, "approved" if i % 2 == 0 else "rejected") for i in range(0, 300, 3)] + [
        (i, "expired") for i in range(300) if i % 3 and i // 3 + 30 < end]
    assert got == sorted(want)
    # What is kept and handed to Python is a state per bucket, not one per call.
    assert 0 < max(s.numRowsTotal for p in done.recentProgress for s in p.stateOperators) <= 4


@pytest.mark.parametrize("held", [lang.HELD, 50])
def test_trigrams_are_counted_in_small_stretches(spark, monkeypatch, held):
    monkeypatch.setattr(lang, "HELD", held)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "unlabelled"), ("xx", None), ("xx", ""), ("xx", "日本語 🙂 abc"), ("xx", "日本語 🙂 abc")], docs.schema))
    want = docs.filter("lang is not null and text is not null").select("lang", F.explode(lang.trigram_numbers(F.col("text"))).alias("code")).groupBy("lang", "code").count()
    assert sorted(map(tuple, lang.count_trigrams(docs, "text", "lang").collect())) == sorted(map(tuple, want.collect()))


def test_arrays_of_a_stretch_are_small():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["a few plain words to count, é " * 100] * 2500)  # 8 MB
    tracemalloc.start()
    seen = sum(len(lang.trigrams_of(characters, borders)[0]) for _, _, characters, borders in lang.batches_of(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 2500 * (3000 - 2) and peak < 16 << 20
