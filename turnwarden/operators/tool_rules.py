"""Rules over tool calls: who may call, with which arguments, how often, and what a result may contain.

A call row holds ``run_id, seq, user_id, tool_name, args map<string,string>, result``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.gates import any_may_match
from turnwarden.functions.patterns import any_of
from turnwarden.functions.text import lines, mapping_text, trim_space
from turnwarden.operators.decisions import record, rewrite, start

# ---------------------------------------------------------------------------------------------- 24 permissions


def with_role(calls: DataFrame, users: DataFrame, default_role: str = fixed.DEFAULT_ROLE) -> DataFrame:
    """Add ``role``; users without one have the default role, of several the first in order of name counts."""
    roles = users.groupBy(F.col("user_id").alias("_u")).agg(F.min("role").alias("_role"))
    joined = calls.join(roles, F.col("user_id") == F.col("_u"), "left")
    return joined.withColumn("role", F.coalesce("_role", F.lit(default_role))).drop("_u", "_role")


def with_permission(calls: DataFrame, users: DataFrame, permissions: DataFrame,
                    default_role: str = fixed.DEFAULT_ROLE) -> DataFrame:
    """Add ``role`` and ``allowed``: whether the role is entitled to the tool."""
    granted = permissions.select(
        F.col("role").alias("_r"), F.col("tool_name").alias("_t"), F.lit(True).alias("_granted")).distinct()
    calls = with_role(calls, users, default_role)
    joined = calls.join(granted, (F.col("role") == F.col("_r")) & (F.col("tool_name") == F.col("_t")), "left")
    return joined.withColumn("allowed", F.col("_granted").isNotNull()).drop("_r", "_t", "_granted")


def denial_detail() -> Column:
    return F.concat(F.lit("user="), F.coalesce("user_id", F.lit("None")), F.lit(" role="), F.col("role"),
                    F.lit(" tool="), F.col("tool_name"))


def tool_permission_check(calls: DataFrame, users: DataFrame, permissions: DataFrame,
                          default_role: str = fixed.DEFAULT_ROLE) -> DataFrame:
    """Deny calls the user's role is not entitled to. ``refusal`` is what the model receives instead of a result."""
    calls = with_permission(calls, users, permissions, default_role)
    calls = record(calls, 24, "Tool permissions (RBAC)", "denied", F.when(~F.col("allowed"), denial_detail()))
    refusal = F.concat(F.lit("Permission denied: role '"), F.col("role"), F.lit("' may not use "), F.col("tool_name"),
                       F.lit(". Tell the user this action is not available to them."))
    return calls.withColumn("refusal", F.when(~F.col("allowed"), refusal))


# ---------------------------------------------------------------------------------------------- 11 arguments

def sql_is_read_only(sql: Column, tokens: Sequence[str] = tuple(fixed.SQL_TOKENS), select_only: bool = True) -> Column:
    """One statement that starts with ``select`` and holds none of the tokens, as substrings."""
    cleaned = F.lower(trim_space(F.regexp_replace(trim_space(sql), r";+\z", "")))
    risky = F.exists(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(cleaned, t))
    return (cleaned.startswith("select") & ~risky) if select_only else ~risky


def _argument(name: str) -> Column:
    """The argument as text: empty when it is not given, ``None`` when it is given without a value."""
    given = F.coalesce(F.map_contains_key("args", name), F.lit(False))
    return F.when(given, F.coalesce(F.try_element_at(F.col("args"), F.lit(name)), F.lit("None"))).otherwise(F.lit(""))


def sql_argument_check(calls: DataFrame, tool: str = "query_appointments_db", argument: str = "sql") -> DataFrame:
    """Refuse calls of the query tool whose statement is not a single read-only SELECT."""
    bad = (F.col("tool_name") == tool) & ~sql_is_read_only(_argument(argument))
    return _refuse(calls, F.when(bad, F.lit(fixed.READ_ONLY_REFUSAL)))


def booking_argument_check(calls: DataFrame, doctors: Sequence[str] = tuple(fixed.DOCTORS),
                           tool: str = "book_appointment", check_doctor: bool = True) -> DataFrame:
    """Refuse bookings with missing fields or an unknown doctor. The date itself is not checked."""
    known = sorted({d.lower() for d in doctors})
    missing = F.array_join(F.array_compact(F.array(
        *[F.when(trim_space(_argument(f)) == "", F.lit(f)) for f in fixed.BOOKING_FIELDS])), ", ")
    surname = F.regexp_replace(F.lower(trim_space(_argument("doctor"))), r"(?U)^dr\.?[\s\x1c-\x1f]+", "")
    reason = F.when(missing != "", F.concat(F.lit("missing "), missing, F.lit(". Ask the user for it.")))
    if check_doctor:
        reason = reason.when(~surname.isin(known), F.concat(
            F.lit("unknown doctor '"), _argument("doctor"), F.lit(f"'. Available: {', '.join(known)}.")))
    return _refuse(calls, F.when(F.col("tool_name") == tool, reason))


def _refuse(calls: DataFrame, reason: Column) -> DataFrame:
    """Record the refusal of calls not refused already and keep the text the model receives."""
    calls = start(calls)
    if "refusal" not in calls.columns:
        calls = calls.withColumn("refusal", F.lit(None).cast("string"))
    calls = calls.withColumn("_reason", F.when(F.col("refusal").isNull(), reason))
    calls = record(calls, 11, "Tool argument validation", "blocked",
                   F.concat(F.col("tool_name"), F.lit(": "), F.col("_reason")))
    return calls.withColumn("refusal", F.coalesce("refusal", F.concat(F.lit("Refused: "), F.col("_reason")))) \
        .drop("_reason")


# ---------------------------------------------------------------------------------------------- 25 tool results

def indirect_injection_scan(results: DataFrame, patterns: Sequence[str] = tuple(fixed.INDIRECT_PATTERNS),
                            text: str = "result", source: str = "tool_name") -> DataFrame:
    """Drop lines with embedded instructions from tool results. A clean result is returned byte for byte.

    A line can only match if the text does, so clean results are scanned once and never cut into lines.
    """
    merged = any_of(patterns, ignore_case=True)
    df = start(results).withColumn("_lower", F.lower(F.col(text)))
    possible = any_may_match(F.col(text), patterns, True, F.col("_lower")) & F.col(text).rlike(merged)
    df = df.withColumn("_lines", F.when(possible, lines(F.col(text))))
    df = df.withColumn("_clean", F.filter("_lines", lambda ln: ~ln.rlike(merged)))
    df = df.withColumn("removed_lines", F.coalesce(F.size("_lines") - F.size("_clean"), F.lit(0)))
    n = F.col("removed_lines").cast("string")
    df = record(df, 25, "Indirect prompt injection", "modified", F.when(
        F.col("removed_lines") > 0,
        F.concat(F.lit("removed "), n, F.lit(" line(s) from "), F.col(source).cast("string"), F.lit(" output"))))
    clean = F.concat(F.lit("[Sanitized: "), n, F.lit(" line(s) with embedded instructions removed]\n"),
                     F.array_join("_clean", "\n"))
    return rewrite(df, text, F.col("removed_lines") > 0, clean).drop("_lines", "_clean", "_lower")


# ---------------------------------------------------------------------------------------------- 8 call cap

def tool_call_cap(calls: DataFrame, limit: int = fixed.TOOL_CALL_LIMIT, call_id: str = "call_id") -> DataFrame:
    """Mark calls beyond the first ``limit`` of their run (``skipped``), in order of ``seq`` and, where it is equal, ``call_id``.

    Only the ``limit``-th call of each run is looked up, by a rank with an upper bound that is cut before the shuffle;
    the calls then join that one row per run, so a run with very many calls is never sorted in one task.
    """
    place = F.struct("seq", F.col(call_id).alias("id"))
    nth = W.partitionBy("run_id").orderBy("place")
    last_kept = (calls.select("run_id", place.alias("place")).withColumn("_n", F.row_number().over(nth))
                 .filter(F.col("_n") <= limit).filter(F.col("_n") == limit)
                 .select("run_id", F.col("place").alias("_last")))
    return (calls.join(last_kept, "run_id", "left")
            .withColumn("skipped", F.coalesce(place > F.col("_last"), F.lit(False))).drop("_last"))


def tool_call_cap_events(calls: DataFrame, limit: int = fixed.TOOL_CALL_LIMIT) -> DataFrame:
    """One #8 event per run that went over the limit. Counts are partial before the shuffle."""
    n = F.col("calls") - limit
    return (calls.groupBy("run_id").agg(F.count("*").alias("calls")).filter(F.col("calls") > limit)
            .select("run_id", F.lit(8).alias("number"), F.lit("Loop control").alias("name"),
                    F.lit("blocked").alias("action"),
                    F.concat(F.lit(f"tool_call_limit={limit}, skipped "), n.cast("string"), F.lit(" call(s)"))
                    .alias("detail")))


# ---------------------------------------------------------------------------------------------- 10 approvals

def approval_reconcile(pending: DataFrame, decisions: DataFrame, users: DataFrame, permissions: DataFrame) -> DataFrame:
    """Settle calls that wait for a human.

    ``pending`` has ``call_id`` next to the call columns; ``decisions`` has ``call_id, approved, note``. A call the
    role is not entitled to is rejected without asking; of the others, those without a decision stay paused.
    """
    # One decision per call, or an approved call would run twice. Of several, a rejection counts.
    first = F.min(F.struct("approved", "note")).alias("_d")
    answers = decisions.groupBy("call_id").agg(first).select(
        "call_id", F.col("_d.approved").alias("approved"), F.col("_d.note").alias("_note"), F.lit(True).alias("_seen"))
    df = start(with_permission(pending, users, permissions)).join(answers, "call_id", "left")
    status = (F.when(~F.col("allowed"), F.lit("auto-rejected"))
              .when(F.col("_seen").isNull(), F.lit("paused"))
              .when(F.col("approved"), F.lit("approved")).otherwise(F.lit("rejected")))
    df = df.withColumn("status", status)

    def when_status(value: str, detail: Column) -> Column:
        return F.when(F.col("status") == value, detail)

    tool = F.col("tool_name")
    note = F.coalesce("_note", F.lit(""))
    df = record(df, 24, "Tool permissions (RBAC)", "denied", when_status("auto-rejected", denial_detail()))
    df = record(df, 10, "Human approval", "paused", when_status("paused", F.concat(tool, F.lit(" awaiting approval"))))
    df = record(df, 10, "Human approval", "approved",
                when_status("approved", F.concat(tool, F.lit("("), mapping_text(F.col("args")), F.lit(")"))))
    df = record(df, 10, "Human approval", "rejected", when_status("rejected", F.concat(tool, F.lit(": "), note)))
    told = F.when(F.col("status") == "rejected", F.when(note != "", note).otherwise(F.lit(fixed.REJECTION_NOTE)))
    return df.withColumns({"executes": F.col("status") == "approved", "told": told}).drop("_note", "_seen", "approved")


def approval_summary(settled: DataFrame) -> DataFrame:
    """The input text under which a resumed run is logged: ``[approval] tool: outcome; ...`` in call order.

    The log keeps 2000 characters and every entry adds more than one, so at most 2000 entries per run can show; the
    bounded rank cuts the rest before the shuffle.
    """
    rank = W.partitionBy("run_id").orderBy("seq", "call_id")
    outcome = F.when(F.col("status") == "auto-rejected", F.lit("auto-rejected (role)")).otherwise(F.col("status"))
    entries = (settled.filter("status <> 'paused'")
               .select("run_id", "seq", "call_id", F.concat("tool_name", F.lit(": "), outcome).alias("_entry"))
               .withColumn("_n", F.row_number().over(rank)).filter(F.col("_n") <= fixed.STORED_INPUT_CHARS))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_entry"))), lambda e: e["_entry"]),
                          "; ")
    return entries.groupBy("run_id").agg(
        F.substring(F.concat(F.lit("[approval] "), joined), 1, fixed.STORED_INPUT_CHARS).alias("input"))


def booked_appointments(settled: DataFrame) -> DataFrame:
    """Appointment rows of approved bookings. The title is removed wherever it stands in the name."""
    surname = trim_space(F.replace(F.replace(_argument("doctor"), F.lit("Dr."), F.lit("")), F.lit("Dr "), F.lit("")))
    return (settled.filter(F.col("executes") & (F.col("tool_name") == "book_appointment") & F.col("refusal").isNull())
            .select("call_id", _argument("patient_name").alias("patient"), surname.alias("doctor"),
                    _argument("date").alias("date"), F.lit("booked").alias("status")))


# ---------------------------------------------------------------------------------------------- 13 typed answers

TRIAGE_SCHEMA = "urgency string, red_flags array<string>, recommended_action string"
TICKET_SCHEMA = "category string, urgency string, summary string"


def value_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def schema_validate(df: DataFrame, schema: str = TRIAGE_SCHEMA,
                    enums: dict[str, Sequence[str]] | None = None, required: Sequence[str] = ("recommended_action",),
                    defaults_to_empty: Sequence[str] = ("red_flags",), report: str = "urgency",
                    fallback: str = fixed.TRIAGE_FALLBACK, text: str = "text") -> DataFrame:
    """Accept JSON answers that have the typed shape; others are replaced by ``fallback``.

    Kinds are those of the JSON values: a number is no string, and a list may be absent but not null or of anything else.
    ``parsed`` holds the typed value of accepted answers (missing lists are empty), NULL for others.
    """
    enums = {"urgency": fixed.TRIAGE_URGENCY} if enums is None else enums
    df = start(df).withColumn("_json", F.try_parse_json(F.col(text)))
    df = df.withColumn("parsed", F.from_json(F.col(text), schema, {"mode": "PERMISSIVE"}))
    value = F.col("parsed")

    def kind(name: str) -> Column:  # of the JSON value itself; NULL where the key is absent
        return F.schema_of_variant(F.try_variant_get("_json", f"$.{name}", "variant"))

    valid = value.isNotNull() & (F.schema_of_variant("_json").startswith("OBJECT"))
    for name, allowed in enums.items():
        valid = valid & (kind(name) == "STRING") & value[name].isin(list(allowed))
    for name in required:
        valid = valid & (kind(name) == "STRING")
    for name in defaults_to_empty:
        held = F.size(F.try_variant_get("_json", f"$.{name}", "array<variant>"))
        valid = valid & (kind(name).isNull() | (kind(name) == "ARRAY<STRING>") | ((kind(name) == "ARRAY<VOID>") & (held == 0)))
    for name in value_names(schema):  # other fields may be absent, but not of another kind
        if name not in enums and name not in required and name not in defaults_to_empty:
            valid = valid & (kind(name).isNull() | (kind(name) == "STRING"))
    df = df.withColumn("valid", F.coalesce(valid, F.lit(False)))
    for name in defaults_to_empty:
        df = df.withColumn("parsed", value.withField(name, F.coalesce(value[name], F.array().cast("array<string>"))))
    df = record(df, 13, "Structured output", "validated",
                F.when(F.col("valid"), F.concat(F.lit(f"{report}="), F.col("parsed")[report])))
    df = record(df, 13, "Structured output", "blocked",
                F.when(~F.col("valid"), F.lit("triage response failed schema validation")))
    answer = F.when(F.col("valid"), F.to_json("parsed", {"ignoreNullFields": "false"})).otherwise(F.lit(fallback))
    return df.withColumns({"answer": answer, "parsed": F.when(F.col("valid"), F.col("parsed"))}).drop("_json")


def ticket_validate(df: DataFrame, text: str = "text") -> DataFrame:
    """The support-ticket shape: two enumerations and a summary."""
    return schema_validate(df, TICKET_SCHEMA, {"category": fixed.TICKET_CATEGORY, "urgency": fixed.TICKET_URGENCY},
                           ("summary",), (), "urgency", text=text)


# ---------------------------------------------------------------------------------------------- the tool stack

def screen_tools(calls: DataFrame, users: DataFrame, permissions: DataFrame,
                 doctors: Sequence[str] = tuple(fixed.DOCTORS), results: DataFrame | None = None) -> DataFrame:
    """Permission first, then arguments, then the result of what ran.

    A refused call never runs: its refusal is the result. ``results`` (``call_id, result``) is joined only to admitted
    calls; without it the calls carry their own ``result``.
    """
    df = tool_permission_check(calls, users, permissions)
    df = sql_argument_check(df)
    df = booking_argument_check(df, doctors)
    df = df.withColumn("executed", F.col("refusal").isNull())
    if results is not None:
        outcome = results.select(F.col("call_id").alias("_id"), F.col("result").alias("_result"))
        df = (df.drop("result").join(outcome, (F.col("call_id") == F.col("_id")) & F.col("executed"), "left")
              .withColumnRenamed("_result", "result").drop("_id"))
    df = df.withColumn("result", F.when(F.col("executed"), F.col("result")))
    df = indirect_injection_scan(df)
    return df.withColumn("result", F.coalesce("refusal", "result"))
