"""Keys that hold most rows: cut into stretches, with the same result as one group per key."""

import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from turnwarden.operators.conversations import conversation_pairs, history_context
from turnwarden.operators.rate_limit import rate_limit


def brute(rows, limit, window):
    """The sliding log, request by request."""
    admitted = defaultdict(deque)
    out = {}
    for user, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        q = admitted[user or "anonymous"]
        while q and at - q[0] > window:
            q.popleft()
        out[i] = len(q) < limit
        if out[i]:
            q.append(at)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_id string, at double, id long").withColumn(
        "ts", F.timestamp_micros((F.col("at") * 1_000_000).cast("long")))


def run(spark, rows, limit, window, **kwargs):
    return {r.id: r.admitted for r in rate_limit(frame(spark, rows), "id", "user_id", "ts", limit, window, **kwargs).collect()}


def test_hand_case(spark):
    times = [0, 1, 2, 3, 4, 61, 62, 62.5, 63]
    rows = [("u", float(t), i) for i, t in enumerate(times)]
    assert [run(spark, rows, 3, 60)[i] for i in range(9)] == [True, True, True, False, False, True, True, True, False]


def test_eleventh_message(spark):
    rows = [(None, i * 0.5, i) for i in range(11)]
    got = run(spark, rows, 10, 60)
    assert [got[i] for i in range(11)] == [True] * 10 + [False]


@pytest.mark.parametrize("spread,step", [(3000, 1), (400, 1), (120, 5), (20000, 1)])
def test_hot_user_equals_brute_force(spark, spread, step):
    rng = random.Random(spread)
    rows = [("hot" if rng.random() < 0.6 else f"u{rng.randrange(5)}" if rng.random() < 0.9 else None,
             float(rng.randrange(0, spread, step)), i) for i in range(900)]
    assert run(spark, rows, 4, 60, group_rows=100) == brute(rows, 4, 60)


@pytest.mark.parametrize("group_rows", [10, 37])
def test_windows_over_stretches(spark, group_rows):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"c{rng.randrange(4)}", i, rng.choice(["user", "assistant", "system"]), str(i))
            for i in rng.sample(range(5000), 400)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")

    def same(operator, **kwargs):
        whole = sorted(map(tuple, operator(df, **kwargs).collect()), key=str)
        cut = sorted(map(tuple, operator(df, group_rows=group_rows, **kwargs).collect()), key=str)
        assert whole == cut and whole

    same(conversation_pairs)
    same(history_context, session="conv_id", order="turn")

def test_rows_without_a_text_do_not_meet_in_one_task(spark):
    """Rows that were stopped before a table of terms is asked have no text to look up."""
    from turnwarden.operators.dictionary import DIGEST, Dictionary, join_back
    spark_conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in spark_conf}
    for k, v in spark_conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(400).select("id", F.when(F.col("id") % 10 == 0, F.lit("a word")).alias("text"))
        terms = spark.createDataFrame([(1, "word")], "ord int, term string")
        found = Dictionary(terms).found(df, F.col("text")).groupBy(*DIGEST).agg(F.min("ord").alias("ord"))
        rows = join_back(df, F.col("text"), found).withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.id, r.text, r.ord) for r in rows if r.ord) == [(i, "a word", 1) for i in range(0, 400, 10)]
    assert len(rows) == 400 and all(r.ord is None for r in rows if r.id % 10)
    assert len({r.p for r in rows if r.text is None}) > 1


def test_small_tables_of_terms_are_looked_up_without_a_shuffle_of_grams(spark, monkeypatch):
    from turnwarden.operators import dictionary, lookups
    from turnwarden.operators import output_rules as out
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Acme and acme corp, ACME.", "Acme and acme corp, ACME.", "a.b corp", "", None])], "id int, text string")
    kb = spark.createDataFrame([(1, "acme", "one"), (1, "acme", "one"), (2, "", "all"), (0, "corp", "two")], "ord int, topic string, text string")
    names = spark.createDataFrame([(1, "Acme"), (2, "acme corp"), (3, "a.b"), (4, "corp")], "ord int, term string")
    answers = []
    for small in (dictionary.SMALL, -1):
        monkeypatch.setattr(dictionary, "SMALL", small)
        found = dictionary.Dictionary(names.withColumn("term", F.lower("term"))).found(docs, F.lower("text"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        answers.append((sorted((r.id, r.kb_result) for r in lookups.kb_match(docs, kb).collect()),
                        sorted((r.id, r.text) for r in out.brand_scrub_table(docs, names, "X").filter("text is not null").collect())))
    assert answers[0] == answers[1]
    assert answers[0][0][0] == (0, "[corp] two\n[acme] one\n[] all") and answers[0][0][3] == (3, "[] all")
    assert answers[0][1] == [(0, "X and X, X."), (1, "X and X, X."), (2, "X X"), (3, "")]
