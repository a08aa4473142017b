"""Sinks: audit tables in Parquet by day, appointments, guarded read-only queries."""

from __future__ import annotations

import uuid

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators.tool_rules import sql_is_read_only


#: What a parsed statement may consist of.
PLANS = set("""Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Distinct Join Union Intersect Except SubqueryAlias
    UnresolvedHaving UnresolvedRelation UnresolvedSubqueryColumnAliases OneRowRelation""".split())
EXPRESSIONS = set("""UnresolvedStar UnresolvedAttribute UnresolvedAlias UnresolvedFunction UnresolvedOrdinal Alias Literal And Or Not
    EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual Between In InSubquery ListQuery ScalarSubquery Exists
    Like RLike LikeAll LikeAny IsNull IsNotNull Add Subtract Multiply Divide Remainder UnaryMinus UnaryPositive CaseWhen Cast SortOrder
    UnresolvedNamedLambdaVariable UnresolvedExtractValue Concat Coalesce""".split())
FUNCTIONS = set("""abs avg between ceil char_length coalesce concat concat_ws contains count count_if date date_add date_diff date_format date_sub
    date_trunc datediff day dayofmonth endswith floor greatest hour if ifnull ilike initcap instr isnotnull isnull least left length like lower ltrim
    max mean median min minute mod month now nullif nvl position power quarter regexp_count regexp_extract regexp_like regexp_replace
    replace reverse right rlike round rtrim second sign split_part sqrt startswith stddev substr substring sum to_date to_timestamp trim trunc
    upper variance year""".split())


def _items(found) -> list:
    """The elements of a sequence of the JVM."""
    at, out = found.iterator(), []
    while at.hasNext():
        out.append(at.next())
    return out


def _refusal(plan, views: set[str]) -> str | None:
    """What a parsed statement names that it may not, read from the tree and not from the text; None if there is nothing."""
    plans, expressions = [plan], []
    while plans or expressions:
        if plans:
            node = plans.pop()
            kind = node.getClass().getSimpleName()
            if kind not in PLANS:
                return kind
            if kind == "UnresolvedRelation":
                name = _items(node.multipartIdentifier())
                if len(name) != 1 or name[0].lower() not in views:
                    return ".".join(name)
            plans += _items(node.children())
            expressions += _items(node.expressions())
            continue
        node = expressions.pop()
        kind = node.getClass().getSimpleName()
        if kind not in EXPRESSIONS:
            return kind
        if kind == "UnresolvedFunction":
            name = _items(node.nameParts())
            if len(name) != 1 or name[0].lower() not in FUNCTIONS:
                return ".".join(name)
        if kind in ("ListQuery", "ScalarSubquery", "Exists"):
            plans.append(node.plan())
        if kind == "InSubquery":
            plans.append(node.query().plan())
        expressions += _items(node.children())
    return None


def append_audit(turns: DataFrame, events: DataFrame, folder: str) -> None:
    """Write both audit tables by day; events follow their turn's day. The days that are written are replaced and all others
    stay, so the append of a day can be repeated."""
    dated = turns.withColumn("dt", F.to_date("ts"))
    for name, df in (("turns", dated), ("events", events.join(dated.select("turn_id", "dt"), "turn_id"))):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{folder}/{name}")


def read_audit_log(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both audit tables; filters on ``dt`` choose the days that are read."""
    return spark.read.parquet(f"{folder}/turns"), spark.read.parquet(f"{folder}/events")


def write_audit_batch(turns: DataFrame, events: DataFrame, folder: str, batch_id: int) -> None:
    """Write one streaming batch so that writing it again replaces it: each batch has its own folder."""
    for name, df in (("turns", turns), ("events", events)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")


def append_appointments(booked: DataFrame, folder: str) -> None:
    booked.write.mode("append").parquet(folder)


def read_only_query(spark: SparkSession, statement: str, views: dict[str, DataFrame],
                    limit: int = fixed.QUERY_ROW_LIMIT) -> DataFrame:
    """Run a statement that passes the read-only check over the given views; at most ``limit`` rows come back.

    The parsed statement may consist of listed nodes, functions and the given views and of nothing else: no tables or views of
    the session, no files, no table functions, and no functions that reach into the runtime, however they are written. The views
    are seen by this statement alone.
    """
    allowed = spark.range(1).select(sql_is_read_only(F.lit(statement)).alias("ok")).first()["ok"]
    if not allowed:
        raise PermissionError(fixed.READ_ONLY_REFUSAL)
    text = statement.strip().rstrip(";")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException:
        raise PermissionError(fixed.READ_ONLY_REFUSAL) from None
    if _refusal(plan, {name.lower() for name in views}):
        raise PermissionError(fixed.READ_ONLY_REFUSAL)
    private = {name: f"only_{uuid.uuid4().hex}" for name in views}
    for name, df in views.items():
        df.createOrReplaceTempView(private[name])
    try:
        shown = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in private.items())
        return spark.sql(f"WITH {shown} {text}" if views else text).limit(limit)
    finally:
        for view in private.values():
            spark.catalog.dropTempView(view)
