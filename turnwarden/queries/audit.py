"""Audit tables of the screened conversations and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import tool_rules as tool
from turnwarden.plans import audit as au
from turnwarden.plans.screening import screened_verdict
from turnwarden.queries.common import ANSWERS_SQL, TURNS_SQL, answers, query, sql_values, turns
from turnwarden.queries.composed import OUTPUT_CTES, screened, screened_answers, screened_ctes
from turnwarden.queries.tool_stage import BOOKING_REASON, SETTLED_SQL, settled
from turnwarden.sources import dimensions as dim
from turnwarden.sources.shared import settle
from turnwarden.sources.sinks import read_only_query


def tools_of(k):
    return (F.when(k % 5 == 0, F.array(F.lit("search_medical_kb"), F.lit("book_appointment")))
            .when(k % 2 == 0, F.array(F.lit("search_medical_kb"))).otherwise(F.array().cast("array<string>")))


TOOLS_SQL = ("CASE WHEN k % 5 = 0 THEN '[\"search_medical_kb\",\"book_appointment\"]' "
             "WHEN k % 2 = 0 THEN '[\"search_medical_kb\"]' ELSE '[]' END")


_LOGS: dict = {}


def logged(spark, folder):
    """(turns, events) of the audit log: verdicts, a latency, the answer that followed as the output rules left it, the tools used.

    The stacks run and the log is written once per application; every question reads it.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LOGS:
        df = screened(spark, folder)
        replies = screened_answers(spark, folder).select((F.col("turn_id") - 1).alias("turn_id"), F.col("text").alias("_answer"))
        df = df.withColumns({
            "verdict": screened_verdict(paused=F.col("k") == 30, failed=F.col("k") == 31),
            "latency_ms": (F.col("turn_id") * 37 % 5000).cast("long"), "tools": tools_of(F.col("k"))})
        df = df.join(replies, "turn_id", "left").withColumn("output", F.when(F.col("verdict") == "ALLOWED", F.col("_answer")))
        _LOGS[key] = settle(df.drop("_answer", "admitted"), "screened")
    return au.turns_table(_LOGS[key]), au.events_table(_LOGS[key])


LOGGED = screened_ctes() + f""", {OUTPUT_CTES},
    logged AS (SELECT s.turn_id, s.ts, s.session_id, s.user_id, s.run_id, s.k,
        CASE WHEN s.blocked_by IS NOT NULL THEN 'BLOCKED' WHEN s.k = 31 THEN 'ERROR' WHEN s.k = 30 THEN 'PAUSED' ELSE 'ALLOWED' END AS verdict,
        s.turn_id * 37 % 5000 AS latency_ms, left(s.text, 2000) AS input, left(a.text, 4000) AS answer
      FROM screened s LEFT JOIN said a ON a.turn_id = s.turn_id + 1),
    log_turns AS (SELECT turn_id, date_trunc('second', ts) AS ts, session_id, user_id, run_id, verdict, latency_ms, input,
        CASE WHEN verdict = 'ALLOWED' THEN answer END AS output, {TOOLS_SQL.replace('k %', 'k %')} AS tools FROM logged),
    log_events AS (SELECT turn_id, generate_subscripts(evs, 1) - 1 AS seq, unnest(evs) AS e FROM screened),
    events_long AS (SELECT turn_id, seq, e.number AS number, e.name AS name, e.action AS action, e.detail AS detail FROM log_events)
"""
CLOCK = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def clock():
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss")


@query("audit_turns", LOGGED + f"SELECT * REPLACE ({CLOCK} AS ts) FROM log_turns")
def _(spark, folder):
    return logged(spark, folder)[0].withColumn("ts", clock())


@query("audit_events", LOGGED + "SELECT * FROM events_long")
def _(spark, folder):
    return logged(spark, folder)[1]


@query("audit_integrity", LOGGED + """, kept AS (SELECT * FROM log_turns WHERE verdict <> 'BLOCKED')
    SELECT 'turns.turn_id' AS "check", count(*) FILTER (WHERE turn_id IS NULL) AS violations FROM kept
    UNION ALL SELECT 'turns.ts', count(*) FILTER (WHERE ts IS NULL) FROM kept
    UNION ALL SELECT 'turns.verdict', count(*) FILTER (WHERE verdict IS NULL) FROM kept
    UNION ALL SELECT 'events.turn_id', count(*) FILTER (WHERE turn_id IS NULL) FROM events_long
    UNION ALL SELECT 'events.number', count(*) FILTER (WHERE number IS NULL) FROM events_long
    UNION ALL SELECT 'events.name', count(*) FILTER (WHERE name IS NULL) FROM events_long
    UNION ALL SELECT 'events.action', count(*) FILTER (WHERE action IS NULL) FROM events_long
    UNION ALL SELECT 'events.orphans', count(*) FROM events_long WHERE turn_id NOT IN (SELECT turn_id FROM kept)""")
def _(spark, folder):
    t, e = logged(spark, folder)
    return au.integrity_report(t.filter("verdict <> 'BLOCKED'"), e)


@query("stage_log", f"""WITH turns AS ({TURNS_SQL}), answers AS ({ANSWERS_SQL})
    SELECT {CLOCK} AS ts, 'input' AS stage, run_id, left(text, 200) AS content, NULL AS tools FROM turns
    UNION ALL SELECT {CLOCK}, 'output', run_id, left(text, 200), {TOOLS_SQL} FROM answers""")
def _(spark, folder):
    out = answers(spark, folder).withColumn("tools", tools_of(F.col("k")))
    return au.stage_log(turns(spark, folder), out).withColumns({"ts": clock(), "tools": F.to_json("tools")})


FIRED = "(SELECT string_agg('#' || number || ' ' || action, ', ' ORDER BY seq) FROM events_long e WHERE e.turn_id = t.turn_id)"


@query("recent_turns", LOGGED + f"""SELECT t.* REPLACE (strftime(t.ts, '%H:%M:%S') AS ts), {FIRED} AS fired
    FROM log_turns t ORDER BY turn_id DESC LIMIT 10""")
def _(spark, folder):
    t, e = logged(spark, folder)
    return au.recent_turns(t, e).withColumn("ts", F.date_format("ts", "HH:mm:ss"))


@query("recent_decisions", LOGGED + """SELECT turn_id, verdict, left(input, 50) AS input FROM log_turns ORDER BY turn_id DESC LIMIT 5""")
def _(spark, folder):
    t, e = logged(spark, folder)
    return au.recent_turns(t, e, 5).select("turn_id", "verdict", F.substring("input", 1, 50).alias("input"))


@query("verdict_share", LOGGED + """SELECT verdict, count(*) AS n,
    CAST(round_even(count(*) / sum(count(*)) OVER () * 100, 0) AS INTEGER) AS share FROM log_turns GROUP BY verdict""")
def _(spark, folder):
    return au.verdict_counts(logged(spark, folder)[0])


@query("firing_counts", LOGGED + "SELECT number, name, action, count(*) AS n FROM events_long GROUP BY number, name, action")
def _(spark, folder):
    return au.firing_counts(logged(spark, folder)[1])


@query("firing_counts_subtotals", LOGGED + "SELECT number, name, action, count(*) AS n FROM events_long GROUP BY ROLLUP (number, name, action)")
def _(spark, folder):
    return au.firing_counts(logged(spark, folder)[1], subtotals=True)


@query("turn_event_dump", LOGGED + """SELECT t.turn_id, t.user_id, t.verdict, e.seq, e.number, e.action, e.detail
    FROM log_turns t LEFT JOIN events_long e USING (turn_id) ORDER BY t.turn_id DESC, e.seq LIMIT 20""")
def _(spark, folder):
    return au.turn_event_dump(*logged(spark, folder))


@query("rule_catalogue", LOGGED + f"""SELECT r.number, r.name, r.stage, count(e.turn_id) AS n
    FROM (VALUES {sql_values(fixed.RULES)}) r(number, name, stage) LEFT JOIN events_long e ON e.number = r.number GROUP BY ALL""")
def _(spark, folder):
    return au.rule_catalogue(dim.rules(spark), logged(spark, folder)[1])


@query("latency_by_verdict", LOGGED + """SELECT verdict, count(*) AS n, round(avg(latency_ms), 3) AS mean_ms,
    quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95, quantile_disc(latency_ms, 0.99) AS p99
    FROM log_turns GROUP BY verdict""")
def _(spark, folder):
    return au.latency_by_verdict(logged(spark, folder)[0])


STATEMENT = "SELECT doctor, status, count(*) AS n, min(date) AS first_day FROM appointments GROUP BY doctor, status ORDER BY doctor;"


@query("appointments_query", f"""WITH {SETTLED_SQL}, appointments AS (
    SELECT call_id, patient, trim(replace(replace(doctor, 'Dr.', ''), 'Dr ', '')) AS doctor, day AS date, 'booked' AS status
    FROM settled WHERE status = 'approved' AND {BOOKING_REASON} IS NULL)
    SELECT * FROM ({STATEMENT.rstrip(';')}) LIMIT 50""")
def _(spark, folder):
    booked = tool.booked_appointments(tool.booking_argument_check(settled(spark, folder)))
    return read_only_query(spark, STATEMENT, {"appointments": booked})


@query("term_list_sizes", f"""SELECT list_name, count(*) AS hits FROM documents, (VALUES {sql_values(
    [(n, t.lower()) for n, ts in (('competitor', fixed.COMPETITORS), ('crisis', fixed.CRISIS_SIGNALS), ('profanity', fixed.PROFANITY_STEMS)) for t in ts])})
    v(list_name, term) WHERE contains(lower(text), term) GROUP BY list_name""")
def _(spark, folder):
    from turnwarden.sources.turns import read_table
    named = {"competitor": fixed.COMPETITORS, "crisis": fixed.CRISIS_SIGNALS, "profanity": fixed.PROFANITY_STEMS}
    hits = F.array_compact(F.array(*[F.when(F.col("t").contains(x.lower()), F.lit(n)) for n, xs in named.items() for x in xs]))
    return (read_table(spark, folder, "documents").select(F.lower("text").alias("t")).select(F.explode(hits).alias("list_name"))
            .groupBy("list_name").agg(F.count("*").alias("hits")))
