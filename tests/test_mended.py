"""Cases that once came out wrong."""

import random
import re

import pytest
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import input_rules as inp
from turnwarden.operators import lookups as look
from turnwarden.operators import output_rules as out
from turnwarden.operators import tool_rules as tool
from turnwarden.operators import verdict_rules as ver
from turnwarden.operators.rate_limit import rate_limit, rate_limit_screen
from turnwarden.plans import screening as scr
from turnwarden.sources import dimensions as dim
from turnwarden.sources.sinks import append_audit, read_audit_log, read_only_query

SMALL = "/root/testdata/sf0.001"


def test_filters_on_keys_reach_the_scan(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    screened = scr.deterministic_input(docs)
    plan = screened.filter("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,5)" in plan
    blocked = screened.filter("blocked_by = 22")
    assert blocked.count() == sum(r.blocked_by == 22 for r in screened.collect())


def test_visible_emoji_stay(screen):
    text = "so \U0001fae0 and \U0001fae8 today"
    assert screen(inp.invisible_text_screen, text) == ([], None, text)
    assert screen(inp.invisible_text_screen, "a͸b")[2] == "ab"


@pytest.mark.parametrize("answer,valid", [
    ('{"urgency":"emergency","red_flags":["a"],"recommended_action":"x"}', True), ('{"urgency":"emergency","recommended_action":"x"}', True),
    ('{"urgency":"emergency","red_flags":[],"recommended_action":"x","more":1}', True), ('{"urgency":"emergency","red_flags":"rash","recommended_action":"x"}', False),
    ('{"urgency":"emergency","red_flags":null,"recommended_action":"x"}', False), ('{"urgency":"emergency","red_flags":[1],"recommended_action":"x"}', False),
    ('{"urgency":"emergency","red_flags":[null],"recommended_action":"x"}', False), ('{"urgency":"emergency","recommended_action":5}', False), ('{"a":1}', False), ('[1]', False)])
def test_typed_answers(spark, answer, valid):
    assert tool.schema_validate(spark.createDataFrame([(answer,)], "text string")).first().valid is valid


def test_repeated_and_partial_verdicts(spark):
    df = spark.createDataFrame([(1, "x" * 10)], "turn_id long, text string")

    def verdicts(*rows):
        return spark.createDataFrame([(1, *r) for r in rows], ver.VERDICT_SCHEMA)
    twice = verdicts((18, 0, "jailbreak", 0.9, True, None), (18, 0, "none", 0.1, False, None), (18, None, "jailbreak", 0.9, True, None))
    assert ver.prompt_attack_screen(df, twice).first().blocked_by == 18
    row = ver.moderation_screen(df, verdicts((7, 0, None, None, None, None))).first()
    assert row.blocked_by == 7 and "unavailable" in row.decisions[0].detail


def test_calls_and_decisions(spark):
    calls = spark.createDataFrame([(i, "r", s, "staff_01", "book_appointment", {"doctor": "Lee"}, "ok") for i, s in ((1, 1), (2, 2), (3, 2), (4, 2))],
                                  "call_id long, run_id string, seq long, user_id string, tool_name string, args map<string,string>, result string")
    assert {r.call_id: r.skipped for r in tool.tool_call_cap(calls, 2).collect()} == {1: False, 2: False, 3: True, 4: True}
    decided = spark.createDataFrame([(1, True, None), (1, True, None), (2, True, None), (2, False, "no")], "call_id long, approved boolean, note string")
    rows = tool.approval_reconcile(calls, decided, dim.users(spark), dim.role_permissions(spark)).collect()
    assert {r.call_id: r.status for r in rows} == {1: "approved", 2: "rejected", 3: "paused", 4: "paused"} and len(rows) == 4


def test_ids_of_any_kind(spark):
    df = spark.createDataFrame([(f"t-{i}", "u", i) for i in range(5)], "id string, user string, s int").withColumn("ts", F.expr("timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, s)"))
    for rows in (1000, 2):  # the second cuts the user into stretches
        got = {r.id: r.admitted for r in rate_limit(df, "id", "user", "ts", 3, 60, rows).collect()}
        assert got == {"t-0": True, "t-1": True, "t-2": True, "t-3": False, "t-4": False}


def test_trust_belongs_to_the_link(spark):
    df = spark.createDataFrame([(1, "https://www.nhs.uk/a"), (1, "https://evil.example/a"), (2, None)], "page_id long, url string")
    domains = spark.createDataFrame([("nhs.uk",)], "domain string")
    assert [r.trusted for r in look.with_trust(df, domains).orderBy("page_id", F.desc("url")).collect()] == [True, False, False]


def test_knowledge_base_of_any_size(spark):
    kb = [(0, "cold", "C"), (1, "fever", "F"), (2, "", "E"), (3, "cold", None), (4, None, "N"), (5, "a.*b", "R"), (6, "überlange überschrift", "U"), (6, "cold", "D")]
    many = kb + [(100 + i, f"topic{i:04}", f"T{i}") for i in range(300)]
    texts = [(1, "a COLD day"), (1, "fever"), (2, "nothing"), (3, None), (4, ""), (5, "axxb a.*b TOPIC0007 topic02990"), (5, "die Überlange Überschrift 🙂 fever"), (1, "fever")]
    asked = spark.createDataFrame(texts, "turn_id long, text string")
    for entries in (kb, many, [(1, None, "x")]):
        got = sorted((r.turn_id, str(r.text), r.kb_result) for r in look.kb_match(asked, spark.createDataFrame(entries, "ord int, topic string, text string")).collect())
        want = []
        for n, t in texts:
            hits = sorted((o, k, x) for o, k, x in set(entries) if t is not None and k is not None and x is not None and k in t.lower())
            want.append((n, str(t), "\n".join(f"[{k}] {x}" for _, k, x in hits) or fixed.KB_MISS))
        assert got == sorted(want)


def test_terms_of_a_table(spark):
    rng = random.Random(4)
    words = ["ban", "bank", "banker", "über", "a-b", "c++", "x", "ban bank", "no one", "straße", "naïve", "don't"] + [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.choice(words + ["banks", "xx", "W7", "BAN", "-", "\n", "urban", "a-bc", "c++,"]) for _ in range(rng.randrange(12)))) for i in range(150)] + [(200, None), (201, "")]
    df = spark.createDataFrame(texts, "turn_id long, text string")
    for listed in (words[:9], words):
        terms = spark.createDataFrame(list(enumerate(listed)) + [(999, None)], "ord int, term string")
        for boundary in (True, False):
            one, table = (sorted((r.turn_id, r.blocked_by, [e.detail for e in r.decisions]) for r in x.collect())
                          for x in (inp.keyword_screen(df, listed, boundary), inp.keyword_screen_table(df, terms, boundary)))
            assert one == table
        found = {r.turn_id: (r.text, [e.detail for e in r.decisions]) for r in out.brand_scrub_table(df, terms, "<$1>").collect()}
        held = [t for t in listed]
        longest = re.compile(r"\b(?:" + "|".join(re.escape(t) for t in sorted(held, key=len, reverse=True)) + r")\b", re.I)
        for n, t in texts:
            names = [w for w in held if t and re.search(r"\b" + re.escape(w) + r"\b", t, re.I)]
            assert found[n] == (longest.sub("<$1>", t) if t else t, [f"scrubbed: {', '.join(names)}"[:300]] if names else []), t


def test_repeated_verdicts_are_settled_by_severity(spark):
    df = spark.createDataFrame([(1, "x" * 10)], "turn_id long, text string")

    def verdicts(*rows):
        return spark.createDataFrame([(1, *r) for r in rows], ver.VERDICT_SCHEMA)
    topic = verdicts((3, 0, "ON_TOPIC", None, None, None), (3, 0, "OFF_TOPIC", None, None, None), (3, 1, "ON_TOPIC", None, None, None))
    assert ver.topical_screen(df, topic).first().blocked_by == 3
    relevant = verdicts((30, 0, "RELEVANT", None, None, None), (30, 0, "IRRELEVANT", None, None, None))
    assert ver.relevance_check(df.withColumn("question", F.lit("q")), relevant).first().decisions[0].action == "modified"
    flags = verdicts((7, 0, None, None, None, {"violence": True, "harassment": False}), (7, 0, None, None, None, {"violence": False, "harassment": True}),
                     (7, 1, None, None, None, {"hate": False}))
    row = ver.moderation_screen(df, flags, ["harassment"]).first()
    assert row.blocked_by == 7 and row.decisions[0].detail == "flagged: harassment, violence"
    assert ver.moderation_screen(df, verdicts((7, 0, None, None, None, {"hate": False}))).first().blocked_by is None


def test_shared_ids_neither_multiply_nor_vanish(spark):
    rows = [(1, "u", 0, "a"), (2, "u", 1, "b"), (7, "u", 2, "c"), (7, "u", 3, "d"), (None, "u", 4, "e"), (None, "u", 4, "f"), (9, None, 4, "g"), (7, "u", 3, "d")]
    df = spark.createDataFrame(rows, "turn_id long, user_id string, s int, text string").withColumn("ts", F.expr("timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, s)"))
    df = df.withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    done = rate_limit_screen(df, "turn_id", "user_id", "ts", 2, 60).collect()
    assert sorted((r.text, r.blocked_by) for r in done) == [("a", None), ("b", None), ("c", 26), ("d", 26), ("d", 26), ("e", 26), ("f", 26), ("g", None)]


def test_statements_see_the_given_views_only(spark):
    mine = spark.createDataFrame([(1,)], "n int")
    spark.createDataFrame([(9,)], "n int").createOrReplaceTempView("t")
    assert read_only_query(spark, "SELECT n FROM t;", {"t": mine}).collect()[0].n == 1 and spark.table("t").first().n == 9
    many = "SELECT upper(concat('a', n)) AS u, count(*) c FROM t WHERE n IN (SELECT n FROM t) AND n BETWEEN 0 AND 5 GROUP BY 1 HAVING count(*) > 0 ORDER BY c LIMIT 3"
    assert read_only_query(spark, many, {"t": mine}).collect() == [("A1", 1)]
    joined = "select a.n, case when b.n is null then 0 else -b.n end x from t a left join t b on a.n = b.n union all select 2, 3"
    assert sorted(map(tuple, read_only_query(spark, joined, {"t": mine}).collect())) == [(1, -1), (2, 3)]
    for bad in ("select java_method('java.lang.Math', 'abs', 1)", f"select * from parquet.`{SMALL}/labels.parquet`", "select * from other", "select * from range(3)",
                "select (select max(n) from other) from t", "select `java_method`('java.lang.System','getProperty','user.home') x from t",
                "select java_method/**/('java.lang.System','getProperty','user.home') x from t", "select n from t where n in (select n from other)",
                "select n from t where exists (select 1 from `other`)", "select reflect('java.lang.Math', 'abs', 1)", "select * from t order by (select max(n) from other)",
                "select n from t where array_contains(array(1), reflect('java.lang.Math', 'abs', 1))", "select current_user() from t", "select n from (table other)",
                "select input_file_name() from t", "select n from default.t", "select not a statement at all from"):
        with pytest.raises(PermissionError):
            read_only_query(spark, bad, {"t": mine})


def test_judge_replies(spark):
    replies = spark.createDataFrame([(1, 18, 0, 'so: {"Attack": TRUE, "type": "X", "confidence": 0.8} ok'), (2, 18, 0, '"attack": true'), (3, 18, 0, "{}"), (4, 18, 0, " "),
                                     (5, 3, 0, " off_topic")], "turn_id long, rule int, chunk_no int, reply string")
    got = {r.turn_id: (r.label, r.confidence, r.attack) for r in ver.parse_judgements(replies).collect()}
    assert got == {1: ("x", 0.8, True), 2: ("unknown", 1.0, True), 3: ("unknown", 1.0, False), 5: ("OFF_TOPIC", None, None)}


def test_a_day_of_the_log_can_be_written_again(spark, tmp_path):
    def day(n, verdict):
        t = spark.sql(f"select {n} as turn_id, timestamp_ntz'2026-01-0{n} 10:00:00' as ts, '{verdict}' as verdict")
        return t, spark.sql(f"select {n} as turn_id, 0 as seq, 4 as number")
    for n, verdict in ((1, "ALLOWED"), (2, "ALLOWED"), (2, "BLOCKED")):
        append_audit(*day(n, verdict), str(tmp_path))
    turns, events = read_audit_log(spark, str(tmp_path))
    assert sorted((r.turn_id, r.verdict) for r in turns.collect()) == [(1, "ALLOWED"), (2, "BLOCKED")] and events.count() == 2


def test_stored_answers_hold_no_personal_data(spark):
    from turnwarden import fixed_values as fixed
    from turnwarden.queries.turn import full_turns
    log = full_turns(spark, SMALL).collect()
    import re
    for r in log:
        for _, pattern in fixed.OUTPUT_PII_PATTERNS:
            assert not re.search(pattern, r.output or ""), r.output
        assert fixed.LEAK_MARKERS[0] not in (r.output or "")
    assert {e.number for r in log for e in r.decisions} >= {10, 11, 14, 20, 24, 25}
