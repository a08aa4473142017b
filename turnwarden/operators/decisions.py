"""The decision column and the fold rule shared by every screening operator.

A screened table carries ``decisions`` (what fired, in order) and ``blocked_by`` (number of the rule that stopped the
row, NULL while it is alive). An operator records and rewrites only rows that are still alive, so applying operators
one after the other is the ordered stack with first-block semantics, evaluated in one pass over the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed

EVENT_TYPE = "struct<number:int,name:string,action:string,detail:string>"
DECISIONS_TYPE = f"array<{EVENT_TYPE}>"


def start(df: DataFrame) -> DataFrame:
    """Give ``df`` an empty decision list unless it has one."""
    if "decisions" in df.columns:
        return df
    return df.withColumns({
        "decisions": F.array().cast(DECISIONS_TYPE),
        "blocked_by": F.lit(None).cast("int"),
    })


def event(number: int, name: str, action: str, detail: Column) -> Column:
    return F.struct(
        F.lit(number).cast("int").alias("number"),
        F.lit(name).alias("name"),
        F.lit(action).alias("action"),
        F.substring(detail, 1, fixed.STORED_DETAIL_CHARS).alias("detail"),
    ).cast(EVENT_TYPE)


def alive() -> Column:
    return F.col("blocked_by").isNull()


def computed_once(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """``df`` with columns replaced, computed in a one-row generator.

    A round reads what the one before wrote more than once. The optimizer moves a later filter below projections by
    copying the expressions it names, which over a stack would multiply without end. It does not move a filter below
    the generator of the column it names, while a filter on any other column still reaches the scan.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in changed.items()]))).alias("_round")
    others = [F.col(f"`{c}`") for c in df.columns if c not in changed]
    return df.select(*others, made).select(
        *[F.col(f"_round.`{c}`").alias(c) if c in changed else F.col(f"`{c}`") for c in df.columns])


def rewrite(df: DataFrame, text: str, condition: Column, new: Column) -> DataFrame:
    """Replace ``text`` where ``condition`` holds."""
    return computed_once(df, {text: F.when(condition, new).otherwise(F.col(f"`{text}`"))})


class Step(NamedTuple):
    """What a rule may record: ``detail`` is NULL where it does not fire; the action ``blocked`` stops the row."""
    number: int
    name: str
    action: str
    detail: Column


def record_all(df: DataFrame, steps: Sequence[Step], helpers: dict[str, Column] | None = None) -> DataFrame:
    """Record several steps that read the same text, in order, up to the first that blocks.

    ``helpers`` are columns that the details read more than once; they are computed first, for live rows only.
    """
    df = start(df)
    kept = df.columns
    if helpers:
        df = df.withColumns({n: F.when(alive(), c) for n, c in helpers.items()})
    df = df.withColumns({f"_d{i}": F.when(alive(), s.detail) for i, s in enumerate(steps)})
    fired = [F.col(f"_d{i}").isNotNull() for i in range(len(steps))]
    entries, stops, stopped = [], [], None
    for step, hit, i in zip(steps, fired, range(len(steps))):
        entry = event(step.number, step.name, step.action, F.col(f"_d{i}"))
        entries.append(F.when(hit if stopped is None else hit & ~stopped, entry))
        if step.action == "blocked":
            stops.append(F.when(hit, F.lit(step.number)))
            stopped = hit if stopped is None else stopped | hit
    any_fired = reduce(lambda x, y: x | y, fired)
    changed = {
        "decisions": F.when(any_fired, F.concat("decisions", F.array_compact(F.array(*entries))))
        .otherwise(F.col("decisions")),
        "blocked_by": F.coalesce("blocked_by", *stops) if stops else F.col("blocked_by"),
    }
    return computed_once(df, changed).select(*[F.col(f"`{c}`") for c in kept])


def record(df: DataFrame, number: int, name: str, action: str, detail: Column) -> DataFrame:
    """Append an event to the rows that are alive and have a ``detail``; ``blocked`` also stops them."""
    return record_all(df, [Step(number, name, action, detail)])


def events_long(df: DataFrame, *keys: str) -> DataFrame:
    """One row per decision, in firing order."""
    return df.select(*keys, F.posexplode("decisions").alias("seq", "e")).select(*keys, "seq", "e.*")
