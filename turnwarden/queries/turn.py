"""Whole turns: every stage in one job, and the audit log that it leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import grounding as gr
from turnwarden.plans import audit as au
from turnwarden.plans.turn import screen_turns
from turnwarden.queries import models as m
from turnwarden.queries.audit import CLOCK, clock
from turnwarden.queries.common import answers, fired_list, lit, query, sql_joined, sql_lines, sql_values, turns
from turnwarden.queries.composed import FIRED_SQL, _output_steps, case_of, screened_ctes
from turnwarden.queries.tool_stage import (ARGS_TEXT, BOOKING_REASON, DENIED, DOCTOR_NAMES, NOTES, POISONED, RISKY_LINE, SQL_BAD, STATEMENTS, _pick,
                                           _sql_pick)
from turnwarden.sources import dimensions as dim
from turnwarden.sources.sinks import append_audit, read_audit_log
from turnwarden.sources.shared import new_folder, settle

KB_RESULT = "Ibuprofen belongs to the NSAID group and works against pain and swelling."
#: (place in the run, tool, which turns call it); the last ones go over the limit.
CALLS = [(1, "search_medical_kb", "k % 2 = 0"), (2, "fetch_health_article", "k % 4 = 0"), (3, "query_appointments_db", "k % 3 = 0"),
         (4, "book_appointment", "k % 5 = 0")] + [(n, "get_medication_info", "k = 16 OR k = 24") for n in range(5, 9)]


def turn_calls(t):
    """The tool calls that the agent made in every turn."""
    made = F.array_compact(F.array(*[F.when(F.expr(when), F.struct(F.lit(n).cast("long").alias("seq"), F.lit(name).alias("tool_name"))) for n, name, when in CALLS]))
    df = t.select("turn_id", "run_id", "user_id", "k", F.explode(made).alias("c")).select("turn_id", "run_id", "user_id", "k", "c.*")
    patient = F.when(F.col("k") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("Customer "), F.col("k").cast("string")))
    args = (F.when(F.col("tool_name") == "query_appointments_db", F.create_map(F.lit("sql"), _pick(STATEMENTS, "k")))
            .when(F.col("tool_name") == "book_appointment", F.create_map(
                F.lit("patient_name"), patient, F.lit("date"), F.lit("2026-10-12"), F.lit("doctor"), _pick(DOCTOR_NAMES, "turn_id")))
            .otherwise(F.create_map(F.lit("query"), F.col("k").cast("string"))))
    result = (F.when(F.col("tool_name") == "fetch_health_article", F.when(F.col("k") % 8 == 0, F.lit(POISONED)).otherwise(F.lit(fixed.ARTICLES[0][1])))
              .when(F.col("tool_name") == "search_medical_kb", F.lit(KB_RESULT)).otherwise(F.lit("ok")))
    return df.withColumns({"call_id": F.col("turn_id") * 16 + F.col("seq"), "args": args, "result": result})


def reviewed(calls):
    """A reviewer's decisions; some calls have none, one has two."""
    c = calls.filter(F.col("tool_name").isin(fixed.CONFIRMED_TOOLS) & ~F.col("k").isin(10, 30))
    once = c.select("call_id", (F.col("turn_id") % 3 != 1).alias("approved"), F.when(F.col("turn_id") % 3 == 1, _pick(NOTES, "k")).alias("note"))
    return once.unionByName(once.filter("call_id % 5 = 0"))


def full_turns(spark, folder):
    t = turns(spark, folder)
    a = answers(spark, folder).withColumn("turn_id", F.col("turn_id") - 1)
    calls = turn_calls(t)
    claims = gr.claims(a.filter("k in (13, 14)"), "turn_id").withColumn("supported", ~F.col("claim").contains("cures"))
    return settle(screen_turns(t, m.verdicts(t), calls, reviewed(calls), dim.users(spark), dim.role_permissions(spark), a, m.verdicts(a), claims,
                               m.language_model(spark, folder), outcomes=measured(t)), "turns")


#: Runs whose model failed, and how long the parts of a run took, in milliseconds.
FAILED, TOOK = "k IN (21, 24, 29)", "(turn_id * 37 + {0} * 11) % 5000"


def measured(t):
    """What the runtime measured of every part of a run; a run that did not pause has a row for its second part too, which nothing reads."""
    parts = t.withColumn("resumed", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("started", F.col("ts").cast("timestamp"))
    took = F.expr(TOOK.format("cast(resumed as int)"))
    return parts.select("run_id", "resumed", (F.expr(FAILED) & ~F.col("resumed")).alias("failed"), "started",
                        F.timestamp_micros(F.unix_micros("started") + took * 1000).alias("finished"))


def _out(number: int, name: str, action: str, detail: str) -> str:
    return f"{{'number': {number}, 'name': {lit(name)}, 'action': {action}, 'detail': left({detail}, 300)}}"


OUT_EVENTS = ", ".join([
    _out(27, "Output PII redaction", "'modified'", "o1.detail"), _out(20, "Secrets detection", "'modified'", "o2.detail"),
    _out(23, "URL allowlist (output)", "'modified'", "o3.detail"), _out(28, "Dangerous code filter", "'modified'", "o4.detail"),
    _out(29, "Toxicity filter", "'modified'", "o5.detail"), _out(9, "System-prompt leak guard", "'modified'", "o6.detail"),
    _out(15, "Brand safety", "'modified'", "o7.detail"), _out(7, "OpenAI moderation (output)", "'modified'", "d7"),
    _out(12, "Output safety judge", "CASE WHEN k = 34 THEN 'skipped' ELSE 'modified' END", "d12"),
    _out(14, "RAG grounding", "CASE WHEN k IN (13, 14) THEN 'modified' ELSE 'skipped' END", "d14"),
    _out(30, "Answer relevance", "CASE WHEN k = 33 THEN 'skipped' ELSE 'modified' END", "d30")])
MADE_SQL = " UNION ALL ".join(f"SELECT turn_id, run_id, user_id, k, CAST({n} AS BIGINT) AS seq, {lit(name)} AS tool_name FROM live WHERE {when}"
                              for n, name, when in CALLS)
EVENT = "{{'number': {0}, 'name': {1}, 'action': {2}, 'detail': left({3}, 300)}}"
TURN_SQL = screened_ctes() + f""",
    live AS (SELECT * FROM screened WHERE blocked_by IS NULL),
    made AS ({MADE_SQL}),
    counted AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS n, count(*) OVER (PARTITION BY run_id) AS total FROM made),
    users AS (SELECT * FROM (VALUES {sql_values(fixed.USERS)}) u(user_id, role)),
    permissions AS (SELECT * FROM (VALUES {sql_values([(r, t) for r, ts in fixed.ROLE_TOOLS.items() for t in ts])}) p(role, tool_name)),
    calls AS (SELECT c.*, c.turn_id * 16 + seq AS call_id, coalesce(u.role, 'guest') AS role, p.tool_name IS NOT NULL AS allowed,
        CASE WHEN c.tool_name = 'query_appointments_db' THEN {_sql_pick(STATEMENTS, 'k')} END AS sql_arg,
        CASE WHEN c.tool_name = 'book_appointment' THEN CASE WHEN k % 7 = 0 THEN '' ELSE 'Customer ' || k END END AS patient,
        CASE WHEN c.tool_name = 'book_appointment' THEN '2026-10-12' END AS day,
        CASE WHEN c.tool_name = 'book_appointment' THEN {_sql_pick(DOCTOR_NAMES, 'turn_id')} END AS doctor,
        CASE WHEN c.tool_name = 'fetch_health_article' THEN CASE WHEN k % 8 = 0 THEN {lit(POISONED)} ELSE {lit(fixed.ARTICLES[0][1])} END
             WHEN c.tool_name = 'search_medical_kb' THEN {lit(KB_RESULT)} ELSE 'ok' END AS result
      FROM counted c LEFT JOIN users u USING (user_id) LEFT JOIN permissions p ON p.role = coalesce(u.role, 'guest') AND p.tool_name = c.tool_name
      WHERE n <= {fixed.TOOL_CALL_LIMIT}),
    settled AS (SELECT *, CASE WHEN NOT allowed THEN 'auto-rejected' WHEN k IN (10, 30) THEN 'paused' WHEN turn_id % 3 <> 1 THEN 'approved' ELSE 'rejected' END AS status,
        CASE WHEN turn_id % 3 = 1 THEN {_sql_pick(NOTES, 'k')} ELSE '' END AS note FROM calls WHERE tool_name = 'book_appointment'),
    waiting AS (SELECT run_id, bool_or(status = 'paused') AS paused FROM settled GROUP BY run_id),
    ready AS (SELECT c.*, c.tool_name = 'book_appointment' AS resumed FROM calls c LEFT JOIN settled s USING (call_id) LEFT JOIN waiting w ON w.run_id = c.run_id
              WHERE c.tool_name <> 'book_appointment' OR (s.status = 'approved' AND NOT w.paused)),
    results AS (SELECT *, CASE WHEN NOT allowed THEN 24 WHEN {SQL_BAD} OR {BOOKING_REASON} IS NOT NULL THEN 11 END AS refused,
        len(list_filter({sql_lines('result')}, lambda ln: {RISKY_LINE})) AS risky FROM ready),
    call_events AS (
      SELECT run_id, resumed, 1 AS stage, seq, 0 AS pos, CASE WHEN refused = 24 THEN {EVENT.format(24, "'Tool permissions (RBAC)'", "'denied'", DENIED)}
          WHEN refused = 11 THEN {EVENT.format(11, "'Tool argument validation'", "'blocked'", "tool_name || ': ' || CASE WHEN " + SQL_BAD + " THEN " + lit(fixed.READ_ONLY_REFUSAL) + " ELSE " + BOOKING_REASON + " END")}
          ELSE {EVENT.format(25, "'Indirect prompt injection'", "'modified'", "'removed ' || risky || ' line(s) from ' || tool_name || ' output'")} END AS e
        FROM results WHERE refused IS NOT NULL OR risky > 0
      UNION ALL SELECT DISTINCT run_id, false, 2, CAST(0 AS BIGINT), 0, {EVENT.format(8, "'Loop control'", "'blocked'", f"'tool_call_limit={fixed.TOOL_CALL_LIMIT}, skipped ' || (total - {fixed.TOOL_CALL_LIMIT}) || ' call(s)'")} FROM counted WHERE total > {fixed.TOOL_CALL_LIMIT}
      UNION ALL SELECT run_id, false, 3, seq, 0, {EVENT.format(10, "'Human approval'", "'paused'", "tool_name || ' awaiting approval'")} FROM settled
      UNION ALL SELECT run_id, true, 0, seq, 0, CASE status WHEN 'auto-rejected' THEN {EVENT.format(24, "'Tool permissions (RBAC)'", "'denied'", DENIED)}
          WHEN 'approved' THEN {EVENT.format(10, "'Human approval'", "'approved'", "tool_name || '(' || " + ARGS_TEXT + " || ')'")}
          ELSE {EVENT.format(10, "'Human approval'", "'rejected'", "tool_name || ': ' || note")} END FROM settled JOIN waiting USING (run_id) WHERE NOT paused),
    gathered AS (SELECT run_id, resumed, list(e ORDER BY stage, seq, pos) AS evs FROM call_events GROUP BY run_id, resumed),
    summaries AS (SELECT run_id, left('[approval] ' || string_agg(tool_name || ': ' || CASE status WHEN 'auto-rejected' THEN 'auto-rejected (role)' ELSE status END,
        '; ' ORDER BY seq), 2000) AS summary FROM settled JOIN waiting USING (run_id) WHERE NOT paused GROUP BY run_id),
    named AS (SELECT run_id, list(tool_name ORDER BY seq) AS tools FROM calls GROUP BY run_id),
    grounded AS (SELECT DISTINCT run_id FROM results WHERE refused IS NULL AND tool_name = 'search_medical_kb'),
    {_output_steps()},
    said AS (SELECT o7.turn_id - 1 AS turn_id, a.k, o7.text AS text0, s.text IS NOT NULL AS asked, g.run_id IS NOT NULL AS grounded,
        a.k = 13 AND contains(lower(a.text), 'cures') AS unsupported, o1.detail AS x1, o7.turn_id AS answer_id
      FROM o7 JOIN answers a USING (turn_id) JOIN o1 USING (turn_id) JOIN screened s ON s.turn_id = o7.turn_id - 1 LEFT JOIN grounded g ON g.run_id = s.run_id),
    judged AS (SELECT *, CASE WHEN text0 = '' THEN NULL WHEN k = 37 THEN 'moderation unavailable (no verdict), withheld'
            WHEN k IN (10, 17) THEN 'flagged: ' || CASE WHEN k = 17 AND conv_odd THEN 'violence, harassment' ELSE 'violence' END END AS d7,
        CASE k WHEN 34 THEN 'judge unavailable (no verdict), failing open' WHEN 11 THEN 'judge: UNSAFE, response replaced' END AS d12,
        CASE WHEN grounded AND unsupported THEN 'unsupported: one tablet cures every migraine for good.'
             WHEN grounded AND k NOT IN (13, 14) THEN 'judge unavailable (no verdict), failing open' END AS d14,
        CASE k WHEN 33 THEN 'judge unavailable (no verdict), failing open' WHEN 12 THEN 'judge: IRRELEVANT, answer replaced' END AS d30
      FROM (SELECT said.*, conv_id % 2 = 1 AS conv_odd FROM said JOIN answers ON answers.turn_id = answer_id)),
    replaced AS (SELECT *, CASE WHEN k = 12 THEN {lit(fixed.IRRELEVANT_REPLACEMENT)} WHEN grounded AND unsupported THEN {lit(fixed.UNGROUNDED_REPLACEMENT)}
        WHEN k = 11 OR d7 IS NOT NULL THEN {lit(fixed.SAFE_REPLACEMENT)} ELSE text0 END AS text1 FROM judged),
    out AS (SELECT replaced.turn_id, list_filter([{OUT_EVENTS}], lambda e: e.detail IS NOT NULL) AS evs,
        CASE WHEN text1 <> '' AND NOT contains(lower(text1), 'not medical advice') THEN text1 || {lit(fixed.DISCLAIMER)} ELSE text1 END AS text
      FROM replaced JOIN o1 ON o1.turn_id = answer_id JOIN o2 ON o2.turn_id = answer_id JOIN o3 ON o3.turn_id = answer_id JOIN o4 ON o4.turn_id = answer_id
      JOIN o5 ON o5.turn_id = answer_id JOIN o6 ON o6.turn_id = answer_id JOIN o7 ON o7.turn_id = answer_id),
    parts AS (SELECT s.*, w.paused, false AS resumed FROM screened s LEFT JOIN waiting w ON w.run_id = s.run_id AND s.blocked_by IS NULL
              UNION ALL SELECT s.*, w.paused, true FROM screened s JOIN waiting w ON w.run_id = s.run_id AND NOT w.paused AND s.blocked_by IS NULL WHERE NOT ({FAILED})),
    whole AS (SELECT p.turn_id, p.resumed, p.ts, p.session_id, p.user_id, p.run_id,
        CASE WHEN blocked_by IS NOT NULL THEN 'BLOCKED' WHEN {FAILED} THEN 'ERROR' WHEN p.paused IS NULL OR p.resumed THEN 'ALLOWED' ELSE 'PAUSED' END AS verdict,
        {TOOK.format('CAST(p.resumed AS INTEGER)').replace('turn_id', 'p.turn_id')} AS latency_ms,
        CASE WHEN p.resumed THEN summary ELSE p.text END AS input,
        CASE WHEN blocked_by IS NOT NULL THEN {case_of(fixed.BLOCK_MESSAGES)} WHEN {FAILED} THEN NULL WHEN p.paused IS NULL OR p.resumed THEN out.text END AS output,
        CASE WHEN blocked_by IS NULL THEN coalesce(tools, []) ELSE [] END AS tools,
        (CASE WHEN p.resumed THEN [] ELSE p.evs END) || coalesce(g.evs, []) ||
          (CASE WHEN blocked_by IS NULL AND NOT ({FAILED}) AND (p.paused IS NULL OR p.resumed) THEN coalesce(out.evs, []) ELSE [] END) AS evs
      FROM parts p LEFT JOIN gathered g ON g.run_id = p.run_id AND g.resumed = p.resumed AND p.blocked_by IS NULL
      LEFT JOIN summaries ON summaries.run_id = p.run_id LEFT JOIN named ON named.run_id = p.run_id LEFT JOIN out ON out.turn_id = p.turn_id)
"""


@query("full_turn", TURN_SQL + f"SELECT turn_id, resumed, verdict, latency_ms, {FIRED_SQL} AS fired, input, output, array_to_string(tools, ',') AS tools FROM whole")
def _(spark, folder):
    df = full_turns(spark, folder)
    return df.select("turn_id", "resumed", "verdict", "latency_ms", fired_list().alias("fired"), F.col("text").alias("input"), "output", F.array_join("tools", ",").alias("tools"))


_LOGS: dict = {}


def logged_turns(spark, folder):
    """The log of all turns, written once per application, by day, and read back; writing it again replaces it."""
    key = (spark.sparkContext.applicationId, folder)
    if key in _LOGS:
        return read_audit_log(spark, _LOGS[key])
    df = full_turns(spark, folder).withColumn("turn_id", F.col("turn_id") * 2 + F.col("resumed").cast("long"))
    path = new_folder(spark, "audit")
    t, e = au.turns_table(df), au.events_table(df)
    for _ in range(2):
        append_audit(t, e, path)
    _LOGS[key] = path
    return read_audit_log(spark, path)


LOG_IDS = "turn_id * 2 + CAST(resumed AS INTEGER)"


@query("audit_log_turns", TURN_SQL + f"""SELECT {LOG_IDS} AS turn_id, {CLOCK} AS ts, session_id, user_id, run_id, verdict,
    latency_ms, left(input, 2000) AS input, left(output, 4000) AS output, CAST(to_json(tools) AS VARCHAR) AS tools FROM whole""")
def _(spark, folder):
    return logged_turns(spark, folder)[0].drop("dt").withColumn("ts", clock())


@query("audit_log_events", TURN_SQL + f"""SELECT turn_id, seq, e.number AS number, e.name AS name, e.action AS action, e.detail AS detail
    FROM (SELECT {LOG_IDS} AS turn_id, generate_subscripts(evs, 1) - 1 AS seq, unnest(evs) AS e FROM whole)""")
def _(spark, folder):
    return logged_turns(spark, folder)[1].drop("dt")
