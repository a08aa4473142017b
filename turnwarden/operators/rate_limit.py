"""Sliding-window admission per user, exact, in batch.

A request is refused iff ``max_requests`` earlier *admitted* requests of the same user are at most ``window_seconds``
old; a refused request leaves no trace. Decisions of one user therefore depend on each other in time order, which no
window frame expresses. Rows are shuffled by user, sorted, and folded partition by partition with a buffer of at most
``max_requests`` times; no user's history is ever gathered.

Hot users are cut into stretches of time that are folded side by side. A stretch first assumes that nothing was
admitted before it; then the times admitted by its predecessor are handed over and only stretches whose hand-over
changed are folded again, until nothing changes. A stretch that contains a quiet moment hands over the same times
whatever it received, so two or three rounds are the rule; the number of stretches is the bound.
"""

from __future__ import annotations

import itertools
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators.decisions import record
from turnwarden.operators.ordered import GROUP_ROWS, cut_hot_keys
from turnwarden.sources.shared import new_folder, settle

ANONYMOUS = "anonymous"


def fold_schema(rows: DataFrame) -> str:
    """The columns of a fold; ids keep the kind that they have in ``rows``."""
    return f"user string, stretch int, at long, id {rows.schema['id'].dataType.simpleString()}, tag long, carried boolean, admitted boolean"


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp without time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def user_key(user: Column) -> Column:
    """Whose history a request belongs to; requests without a user share one."""
    key = user.cast("string")
    return F.when(key.isNull() | (key == ""), F.lit(ANONYMOUS)).otherwise(key)


def requests(df: DataFrame, id_column: str, user: str, ts: str, tag: Column | None = None) -> DataFrame:
    """The narrow columns admission needs. ``tag`` tells rows of one id and time apart."""
    return df.select(user_key(F.col(user)).alias("user"), micros(F.col(ts)).alias("at"), F.col(id_column).alias("id"),
                     (F.lit(0).cast("long") if tag is None else tag).alias("tag"), F.lit(False).alias("carried"))


def folder(max_requests: int, window: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Admission over rows sorted by (user, stretch, at, id, tag). Carried rows are already admitted."""

    def fold(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, admitted = None, deque()
        for pdf in batches:
            out = []
            for user, stretch, at, carried in zip(pdf["user"].tolist(), pdf["stretch"].tolist(), pdf["at"].tolist(),
                                                  pdf["carried"].tolist()):
                if (user, stretch) != current:
                    current = (user, stretch)
                    admitted.clear()
                while admitted and at - admitted[0] > window:
                    admitted.popleft()
                free = carried or len(admitted) < max_requests
                if free:
                    admitted.append(at)
                out.append(free)
            yield pdf.assign(admitted=out)

    return fold


def _fold(rows: DataFrame, max_requests: int, window: int) -> DataFrame:
    ordered = (rows.select("user", "stretch", "at", "id", "tag", "carried")
               .repartition("user", "stretch")
               .sortWithinPartitions("user", "stretch", "at", F.col("carried").desc(), "id", "tag"))
    return ordered.mapInPandas(folder(max_requests, window), fold_schema(rows))


def _exits(folded: DataFrame, max_requests: int) -> DataFrame:
    """(user, stretch, times): the last admitted times of each stretch, at most ``max_requests`` of them."""
    newest = W.partitionBy("user", "stretch").orderBy(F.col("at").desc(), F.col("id").desc())
    return (folded.filter("admitted").withColumn("_n", F.row_number().over(newest))
            .filter(F.col("_n") <= max_requests)
            .groupBy("user", "stretch").agg(F.array_sort(F.collect_list("at")).alias("times")))


def _hand_over(exits: DataFrame, starts: DataFrame, window: int) -> DataFrame:
    """What each stretch receives: the times its predecessor ended with that its first request can still see."""
    seen = F.filter("times", lambda t: F.col("first_at") - t <= window)
    received = exits.withColumn("stretch", F.col("stretch") + 1).join(starts, ["user", "stretch"], "right")
    return received.select("user", "stretch", F.coalesce(seen, F.array().cast("array<bigint>")).alias("times"))


def _settle_hot(hot: DataFrame, max_requests: int, window: int) -> DataFrame:
    """Fold the stretches of hot users until every stretch has received what its predecessor really ended with."""
    spark = hot.sparkSession
    stored = new_folder(spark, "hot-requests")
    id_type = hot.schema["id"].dataType
    schema = fold_schema(hot)
    hot.select("user", "stretch", "at", "id", "tag", "carried").write.partitionBy("stretch").parquet(stored)
    rows = spark.read.schema(f"user string, at long, id {id_type.simpleString()}, tag long, carried boolean, stretch int").parquet(stored)
    starts = settle(rows.groupBy("user", "stretch").agg(F.min("at").alias("first_at")), "stretch-starts")

    rounds = new_folder(spark, "admission")

    def fold_round(n: int, chosen: DataFrame) -> DataFrame:
        _fold(chosen, max_requests, window).write.parquet(f"{rounds}/round={n}")
        return spark.read.schema(schema).parquet(f"{rounds}/round={n}")

    exits = settle(_exits(fold_round(0, rows), max_requests), "stretch-exits")
    latest = settle(starts.select("user", "stretch", F.lit(0).alias("round")), "latest-round")
    received = settle(starts.select("user", "stretch", F.array().cast("array<bigint>").alias("times")), "received")
    for n in itertools.count(1):
        due = settle(_hand_over(exits, starts, window), "received")
        changed = settle(due.join(received.withColumnRenamed("times", "before"), ["user", "stretch"])
                         .filter(F.col("times") != F.col("before")).drop("before"), "changed")
        numbers = [r[0] for r in changed.select("stretch").distinct().collect()]  # at most one per stretch number
        if not numbers:
            break
        carried = (changed.select("user", "stretch", F.explode("times").alias("at"))
                   .withColumns({"id": F.lit(None).cast(id_type), "tag": F.lit(0).cast("long"), "carried": F.lit(True)}))
        again = rows.filter(F.col("stretch").isin(numbers)).join(changed, ["user", "stretch"], "left_semi")
        folded = fold_round(n, again.unionByName(carried))
        exits = settle(exits.join(changed, ["user", "stretch"], "left_anti")
                       .unionByName(_exits(folded, max_requests)), "stretch-exits")
        latest = settle(latest.join(changed, ["user", "stretch"], "left_anti")
                        .unionByName(changed.select("user", "stretch", F.lit(n).alias("round"))), "latest-round")
        received = due
    folded = spark.read.schema(schema + ", round int").parquet(rounds)
    return (folded.filter("not carried").join(latest, ["user", "stretch", "round"], "left_semi")
            .select(*DECIDED))


DECIDED = ["id", "user", "at", "tag", "admitted"]


def decide(narrow: DataFrame, max_requests: int, window: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Admission of narrow rows (``requests``): id, user, at, tag, admitted. Carried rows were admitted before; they count and are
    not returned."""
    cold, hot = cut_hot_keys(narrow, "user", "at", group_rows)
    decided = _fold(cold.withColumn("stretch", F.lit(0)), max_requests, window).filter("not carried").select(*DECIDED)
    return decided if hot is None else decided.unionByName(_settle_hot(hot, max_requests, window))


def rate_limit(df: DataFrame, id_column: str, user: str, ts: str, max_requests: int = fixed.RATE_MAX_REQUESTS,
               window_seconds: float = fixed.RATE_WINDOW_SECONDS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, user, admitted) for every row of ``df``; ties in time are taken in ``id`` order."""
    return decide(requests(df, id_column, user, ts), max_requests, int(round(window_seconds * 1_000_000)), group_rows).select("id", "user", "admitted")


def _hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed: no maps and no variants."""
    return [f"`{f.name}`" for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]


def rate_limit_screen(df: DataFrame, id_column: str, user: str, ts: str,
                      max_requests: int = fixed.RATE_MAX_REQUESTS, window_seconds: float = fixed.RATE_WINDOW_SECONDS,
                      group_rows: int = GROUP_ROWS) -> DataFrame:
    """Block the refused rows of a turn table. Only (id, user, time, hash of the row) is sorted; the wide rows join the outcome.

    Every row is a request of its own, whether or not it shares its id with others; rows that are equal in all columns are one
    request that was delivered more than once, and share its outcome. Rows are neither lost nor multiplied.
    """
    tag = F.xxhash64(*_hashable(df))
    decided = decide(requests(df, id_column, user, ts, tag).distinct(), max_requests, int(round(window_seconds * 1_000_000)), group_rows)
    refused = decided.filter(~F.col("admitted")).select(
        F.col("id").alias("_id"), F.col("at").alias("_at"), F.col("tag").alias("_tag"), F.col("user").alias("_user"),
        F.concat("user", F.lit(f": {max_requests} req / {window_seconds:.0f}s")).alias("_refused"))
    same = (F.col(f"`{id_column}`").eqNullSafe(F.col("_id")) & micros(F.col(ts)).eqNullSafe(F.col("_at")) & (tag == F.col("_tag"))
            & (user_key(F.col(user)) == F.col("_user")))
    joined = df.join(refused, same, "left").drop("_id", "_at", "_tag", "_user")
    return record(joined, 26, "Rate limit", "blocked", F.col("_refused")).drop("_refused")
