"""The same operators over streams of the given files, drained to tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.plans.screening import InputSettings
from turnwarden.queries.common import fired_list, lit, query, sql_values, turns
from turnwarden.queries.composed import AFTER_MASK, FIRED_SQL, screened_ctes
from turnwarden.queries.input_stage import (CRISIS_SQL, HIDDEN_SQL, INJECTION_SQL, PAYLOAD_SQL, SECRETS_SQL, TAG_SQL,
                                            gibberish_detail_sql, keyword_sql, length_sql, mask_steps_sql, rate_limit_sql,
                                            url_detail_sql)
from turnwarden.sources import dimensions as dim
from turnwarden.sources.shared import new_folder, settle
from turnwarden.sources.turns import EVENT_SCHEMA, stream_table
from turnwarden.streaming.approvals import approvals_stream
from turnwarden.streaming.rate_limit import rate_limit_stream
from turnwarden.streaming.run import drain, drain_batches, stateful_session
from turnwarden.streaming.screening import (audit_batch, firing_counts_stream, read_audit, read_counts, screen_stream, screen_stream_judged,
                                            upsert_counts)

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STACK = [(4, length_sql(2000), "text"), (19, f"CASE WHEN regexp_matches(text, {lit(TAG_SQL)}) THEN {PAYLOAD_SQL} END", "text"),
         (22, gibberish_detail_sql(), "visible"), (16, CRISIS_SQL, "visible"), (2, INJECTION_SQL, "visible"),
         (20, SECRETS_SQL, "visible"), (1, keyword_sql(fixed.BANNED_KEYWORDS), "masked"), (23, url_detail_sql(), "masked")]
VISIBLE = f"SELECT doc_id, regexp_replace(text, {lit(HIDDEN_SQL)}, '', 'g') AS text FROM documents"
def stack_sql(stack, more: str = "") -> str:
    """The first rule of a stack that fires on each document; ``more`` are further tables that the rules read."""
    return (f"WITH visible AS ({VISIBLE}), masked AS ({mask_steps_sql('visible', 'doc_id', fixed.INPUT_PII_PATTERNS + fixed.CUSTOM_PII_PATTERNS)}), "
            + (more + ", " if more else "")
            + ", ".join(f"s{n} AS (SELECT doc_id FROM {'documents' if src == 'text' else src} WHERE ({d}) IS NOT NULL)" for n, d, src in stack)
            + ", decided AS (SELECT doc_id, CASE " + " ".join(f"WHEN doc_id IN (SELECT doc_id FROM s{n}) THEN {n}" for n, _, _ in stack)
            + " END AS blocked_by FROM documents) ")


STACK_SQL = stack_sql(STACK)


@query("screen_stream", STACK_SQL + "SELECT doc_id, blocked_by, CASE WHEN blocked_by IS NULL THEN 'ALLOWED' ELSE 'BLOCKED' END AS verdict FROM decided")
def _(spark, folder):
    docs = stream_table(spark, folder, "documents", DOCUMENT_SCHEMA)
    return drain(screen_stream(docs).select("doc_id", "blocked_by", "verdict"), "screen-stream")


@query("audit_stream", STACK_SQL + "SELECT CASE WHEN blocked_by IS NULL THEN 'ALLOWED' ELSE 'BLOCKED' END AS verdict, count(*) AS turns FROM decided GROUP BY 1")
def _(spark, folder):
    docs = stream_table(spark, folder, "documents", DOCUMENT_SCHEMA)
    screened = screen_stream(docs.withColumn("turn_id", F.col("doc_id")).withColumn("ts", F.current_timestamp()))
    out = new_folder(spark, "audit")
    drain_batches(screened, audit_batch(out), "audit-stream")
    return read_audit(spark, out, "turns").groupBy("verdict").agg(F.count("*").alias("turns"))


@query("rate_limit_stream", f"WITH RECURSIVE {rate_limit_sql('events', 'event_id', 'user_id', 'ts', 3, 86400)} "
                            "SELECT id, u AS user, admitted FROM fold")
def _(spark, folder):
    return rate_limit_stream(stream_table(spark, folder, "events", EVENT_SCHEMA), "event_id", "user_id", "ts", 3, 86400)


ACTION_RULES = [("error", 2, "blocked"), ("view", 5, "modified"), ("click", 24, "denied"), ("signup", 10, "paused"),
                ("purchase", 13, "validated")]


@query("firing_counts_stream", f"""
    SELECT strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M:%S') AS window_start, number, action, count(*) AS n
    FROM events JOIN (VALUES {sql_values(ACTION_RULES)}) r(event_type, number, action) USING (event_type) GROUP BY 1, 2, 3""")
def _(spark, folder):
    rules = F.broadcast(spark.createDataFrame(ACTION_RULES, "event_type string, number int, action string"))
    events = stream_table(spark, folder, "events", EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    out = new_folder(spark, "firing-counts")
    drain_batches(firing_counts_stream(events.join(rules, "event_type")), upsert_counts(out), "firing-counts", "update")
    return read_counts(spark, out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


# Decisions: one in time, none, one too late; some of them again, the other way round. Some users are not entitled to the tool.
@query("approvals_stream", f"""WITH asked AS (SELECT event_id AS call_id, ts AS asked_at, CASE user_id % 4 WHEN 0 THEN 'guest' WHEN 1 THEN 'patient'
          WHEN 2 THEN 'staff' ELSE 'guest' END AS role, user_id % 2 = 0 AS yes FROM events WHERE event_type = 'signup'),
    decided AS (SELECT call_id, asked_at + CASE WHEN call_id % 7 = 1 THEN INTERVAL 2 hours ELSE INTERVAL 5 minutes END AS tm, yes FROM asked WHERE call_id % 3 <> 2
                UNION ALL SELECT call_id, asked_at + INTERVAL 7 minutes, NOT yes FROM asked WHERE call_id % 5 = 0),
    first AS (SELECT call_id, arg_min(decided.yes, tm) AS yes FROM decided JOIN asked USING (call_id) WHERE tm <= asked_at + INTERVAL 1 hour GROUP BY call_id),
    last AS (SELECT greatest((SELECT max(asked_at) FROM asked), (SELECT max(tm) FROM decided)) - INTERVAL 10 minutes AS w),
    allowed AS (SELECT a.*, role IN ({{roles}}) AS ok FROM asked a)
    SELECT call_id, CASE WHEN ok THEN 'paused' ELSE 'auto-rejected' END AS status FROM allowed
    UNION ALL SELECT call_id, CASE WHEN first.yes THEN 'approved' ELSE 'rejected' END FROM allowed JOIN first USING (call_id) WHERE ok
    UNION ALL SELECT call_id, 'expired' FROM allowed LEFT JOIN first USING (call_id), last WHERE ok AND first.call_id IS NULL AND asked_at + INTERVAL 1 hour < w
    """.replace("{roles}", ", ".join(lit(r) for r, tools in fixed.ROLE_TOOLS.items() if "book_appointment" in tools)))
def _(spark, folder):
    own = stateful_session(spark)
    events = stream_table(own, folder, "events", EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp")).filter("event_type = 'signup'")
    user = F.element_at(F.array(*[F.lit(u) for u in ("guest_01", "patient_01", "staff_01", "nobody")]), (F.col("user_id") % 4 + 1).cast("int"))
    pending = events.select(F.col("event_id").alias("call_id"), F.col("ts").alias("asked_at"), user.alias("user_id"), F.lit("book_appointment").alias("tool_name"))
    yes, wait = F.col("user_id") % 2 == 0, F.when(F.col("event_id") % 7 == 1, F.expr("interval 2 hours")).otherwise(F.expr("interval 5 minutes"))
    note = F.lit(None).cast("string").alias("note")
    once = events.filter("event_id % 3 <> 2").select(F.col("event_id").alias("call_id"), (F.col("ts") + wait).alias("decided_at"), yes.alias("approved"), note)
    again = events.filter("event_id % 5 = 0").select(F.col("event_id").alias("call_id"), (F.col("ts") + F.expr("interval 7 minutes")).alias("decided_at"), (~yes).alias("approved"), note)
    done = drain(approvals_stream(pending, once.unionByName(again), dim.users(own), dim.role_permissions(own)), "approvals", spark)
    return done.select("call_id", "status")


def replies(t):
    """What the judges replied to the turns: in time or too late, once or twice, in all shapes."""
    def said(rule, text, when=None, chunk=0, wait="30 seconds"):
        row = F.struct(F.lit(rule).alias("rule"), F.lit(chunk).alias("chunk_no"), text.alias("reply"), (F.col("ts") + F.expr(f"interval {wait}")).alias("replied_at"))
        return row if when is None else F.when(when, row)

    k, odd = F.col("k"), F.col("conv_id") % 2 == 1
    attack = F.when(k == 8, '{"attack": true, "type": "jailbreak", "confidence": 0.92}').when(k == 20, '{"attack": true, "type": "jailbreak", "confidence": 0.4}') \
        .when(k == 21, '```{"Attack": true, "Type": "jailbreak"}```').otherwise('{"attack": false, "type": "none"}')
    flags = F.when((k == 17) & odd, '{"categories": {"violence": true, "harassment": true}}').when(k.isin(17, 10), '{"violation": 1, "category": "violence"}') \
        .otherwise('{"categories": {"violence": false}}')
    rows = [said(3, F.when(k.isin(2, 5, 6), F.lit("off_topic")).otherwise(F.lit(" On_Topic\n")), ~k.isin(39, 5)), said(3, F.lit("OFF_TOPIC"), k == 5, 0, "2 hours"),
            said(3, F.lit("ON_TOPIC"), k == 6), said(16, F.when(k == 7, F.lit("Yes, risk")).otherwise(F.lit("no")), k != 38), said(7, flags, k != 37),
            said(18, attack, k != 36), said(18, F.lit('{"attack": false, "type": "none", "confidence": 0.1}'), k == 3, 1)]
    return t.select("turn_id", F.col("ts").alias("asked_at"), F.explode(F.array_compact(F.array(*rows))).alias("r")).select("turn_id", "asked_at", "r.*")


JUDGED = [s if s[0] not in (3, 7) else (s[0], s[1], s[2], s[3].replace("k = 39", "k IN (39, 5)").replace("k = 2 ", "k IN (2, 6) ").replace(
    "violence, harassment", "harassment, violence")) for s in AFTER_MASK]


@query("screen_stream_judged", screened_ctes(False, admission=False, after_mask=JUDGED) + f"""
    SELECT turn_id, blocked_by, CASE WHEN blocked_by IS NULL THEN 'ALLOWED' ELSE 'BLOCKED' END AS verdict, {FIRED_SQL} AS fired, text FROM screened""")
def _(spark, folder):
    t = turns(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    # A last row on both streams, a day later, moves the watermark past all others, as a heartbeat would; it is not returned itself.
    last = t.orderBy(F.col("ts").desc()).limit(1).withColumns({"turn_id": F.lit(-1).cast("long"), "ts": F.col("ts") + F.expr("interval 1 day"), "k": F.lit(0)})
    given = settle(t.unionByName(last), "stream-turns")
    asked = settle(replies(given), "stream-replies")
    streams = [spark.readStream.schema(df.schema).parquet(df.inputFiles()[0].rsplit("/", 1)[0]) for df in (given, asked)]
    done = screen_stream_judged(*streams, settings=InputSettings(skip=(26, 21)))
    return drain(done.select("turn_id", "blocked_by", "verdict", fired_list().alias("fired"), "text"), "judged-stream")
