"""A user's own rules in the input stack.

A rule says which version of the text it reads (as it came, without invisible characters, with personal data masked), behind which
rule of that round it stands, and what it records. It may need columns of its own: of a join with a table, or of a scorer over
batches of text. Those are added before its round; the steps of all rules of a round are recorded in one pass, as ever.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden.operators.decisions import Step, alive
from turnwarden.operators.dictionary import DIGEST, Dictionary, join_back
from turnwarden.operators.scorers import score_with
from turnwarden.operators.verdict_rules import fail_policy

RAW, VISIBLE, MASKED = "raw", "visible", "masked"


class Rule(NamedTuple):
    """``steps`` get the text column; ``prepare`` gets the table and the text of live rows (else null) and adds columns whose names
    begin with ``_own``."""
    number: int
    steps: Callable[[Column], list[Step]]
    version: str = MASKED
    after: int | None = None
    prepare: Callable[[DataFrame, Column], DataFrame] | None = None


def column_rule(number: int, name: str, detail: Callable[[Column], Column], version: str = MASKED, after: int | None = None,
                action: str = "blocked") -> Rule:
    """A rule that needs nothing but the text: ``detail`` gives what is reported, or null."""
    return Rule(number, lambda text: [Step(number, name, action, detail(text))], version, after)


def table_rule(number: int, name: str, terms: DataFrame, version: str = MASKED, after: int | None = None, action: str = "blocked",
               at_words: bool = True) -> Rule:
    """A rule that fires on the terms of a table (ord, term) of any size, in any case; the one with the least ``ord`` is reported."""
    column = f"_own{number}"

    def prepare(df: DataFrame, text: Column) -> DataFrame:
        entries = terms.select("ord", F.lower("term").alias("term"), F.col("term").alias("_shown"))
        found = Dictionary(entries, at_words=at_words).found(df, F.lower(text)).groupBy(*DIGEST).agg(F.min(F.struct("ord", "_shown"))["_shown"].alias(column))
        return join_back(df, F.lower(text), found)

    return Rule(number, lambda text: [Step(number, name, action, F.concat(F.lit("term: "), F.col(column)))], version, after, prepare)


def scorer_rule(number: int, name: str, load: Callable[[], Callable[[pd.Series], pd.Series]], threshold: float, version: str = MASKED,
                after: int | None = None, action: str = "blocked", fail_closed: bool = False) -> Rule:
    """A rule that fires where a user's model scores at least ``threshold``. ``load`` runs once per task; where the model gives no
    score the check is unavailable, and the rule fails open or closed."""
    column = f"_own{number}"

    def prepare(df: DataFrame, text: Column) -> DataFrame:
        return score_with(df.withColumn("_given", text), load, "_given", column).drop("_given")

    def steps(text: Column) -> list[Step]:
        score = F.col(column)
        return [fail_policy(number, name, score, fail_closed),
                Step(number, name, action, F.when(score >= threshold, F.concat(F.lit("score "), F.format_string("%.2f", score))))]

    return Rule(number, steps, version, after, prepare)


def prepared(df: DataFrame, rules: Sequence[Rule], version: str, text: str) -> tuple[DataFrame, list[tuple[int | None, list[Step]]]]:
    """The columns that the rules of a round need, and their steps with the rule that they stand behind."""
    mine = [r for r in rules if r.version == version]
    for rule in mine:
        if rule.prepare is not None:
            df = rule.prepare(df, F.when(alive(), F.col(text)))
    return df, [(r.after, r.steps(F.col(text))) for r in mine]


def placed(steps: list[Step], own: list[tuple[int | None, list[Step]]]) -> list[Step]:
    """The steps of a round with those of a user's rules behind the rules they name, or at the end."""
    out = list(steps)
    for after, more in own:
        at = max((i + 1 for i, step in enumerate(out) if step.number == after), default=len(out))
        out[at:at] = more
    return out
