"""Quality rules: a table of thresholds compiled into one projection; no user functions, no shuffle.

Every measure is a column over the whole text, every rule compares the ratio of two measures with a lowest and a highest
value. A text that breaks any rule is rejected, and ``failed`` names the rules in table order.

Defined results: a null or blank text has no words and fails. A ratio over zero passes its rule (the word count has a rule
of its own). Repeated rows, null ids and other columns pass through; columns of the input that carry a name the operator
returns are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden.llm.text import computed_once, words

WINDOW = 5

#: The most frequent function words of the four languages, in lower case.
STOP_WORDS = (
    "the of and to in is that for was with as it on are this by be from at not have or an a "
    "der die das und in zu den von mit ist des im dem nicht ein eine als auch es auf für sich an "
    "de la le les et des en un une du est pour que qui dans par sur pas au avec ce il plus "
    "el la los las de en y que un una por con para es del se no al lo su como más"
).split()
SYMBOLS = "[#*$%&|<>]"


class Rule(NamedTuple):
    """``low <= numerator / denominator <= high`` for texts of at least ``words`` words; a bound of None is open."""
    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None
    words: int = 0


RULES = (
    Rule("few_words", "n_words", None, 10, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.2),
    Rule("word_length", "word_chars", "n_words", 2, 15),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, 50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)
BASE = ("few_words", "repeated_words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def fails(rule: Rule) -> Column:
    """True where the rule is broken. Bounds are whole per cent and multiplied out, so no rounding decides."""
    value = F.col(rule.numerator) * 100
    over = F.col(rule.denominator) if rule.denominator else F.lit(1)
    broken = F.lit(False)
    if rule.low is not None:
        broken = broken | (value < over * int(round(rule.low * 100)))
    if rule.high is not None:
        broken = broken | (value > over * int(round(rule.high * 100)))
    broken = broken & (over > 0) if rule.denominator else broken
    return broken & (F.col("n_words") >= rule.words) if rule.words else broken


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures, linear in the length of the text but for one sort of texts that repeat a window.

    Windows of five words are first compared by hash: without equal hashes there is no repeat, and nothing more is done.
    Only otherwise are the windows themselves sorted with their places.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in {*MEASURES, "failed", "base_failed", "kept"}]

    def at(array: str, i: Column) -> Column:
        return F.get(F.col(array), i)

    stops = sorted({w for x in STOP_WORDS for w in (x, x.capitalize(), x.upper())})
    step = docs.select(*kept, words(full).alias("_w"), F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    step = step.select(
        *kept, "_w", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.size(F.split(full, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
        F.size(F.filter("_w", lambda x: x.isin(stops))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_hw"))
    done = [*kept, *[m for m in MEASURES if m != "n_repeat_words"]]
    starts = F.sequence(F.lit(0), F.size("_w") - WINDOW)
    step = step.select(*done, "_w", F.when(F.size("_w") > WINDOW, F.transform(
        starts, lambda i: F.xxhash64(*[at("_hw", i + k) for k in range(WINDOW)]))).alias("_h"))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    # Referring to the words more than once keeps the optimizer from moving their making into the lambda.
    step = step.select(*done, F.when(repeats, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size("_w") - WINDOW),
        lambda i: F.struct(F.concat_ws(" ", *[at("_w", i + k) for k in range(WINDOW)]).alias("g"), i.alias("i"))))).alias("_s"))
    same = F.filter("_s", lambda x, k: (at("_s", k + 1)["g"] == x["g"]) | ((k > 0) & (at("_s", k - 1)["g"] == x["g"])))
    step = step.select(*done, F.sort_array(F.transform(same, lambda x: x["i"])).alias("_p"))
    cover = F.aggregate(F.transform("_p", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(at("_p", k + 1) - x, F.lit(WINDOW)))),
                        F.lit(0), lambda a, x: a + x)
    step = step.select(*done, F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"))
    return computed_once(step, kept, MEASURES)


def apply_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``failed`` (comma-joined names) and ``kept``."""
    measured = measure(docs, text)
    base = F.lit(False)
    for rule in (r for r in rules if r.name in BASE):
        base = base | fails(rule)
    names = F.concat_ws(",", *[F.when(fails(r), F.lit(r.name)) for r in rules])
    return measured.withColumns({"base_failed": base, "failed": names}).withColumn("kept", F.col("failed") == "")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs[f"`{text}`"].alias("_text"))
    return apply_rules(held, "_text").filter("kept").select("_row.*")


def rules_sql(rules=RULES) -> tuple[str, str]:
    """The rules as SQL conditions: base verdict, and the comma-joined names of all that fail."""
    def cond(r: Rule) -> str:
        over = r.denominator or "1"
        parts = [f"{r.numerator} * 100 < {over} * {int(round(r.low * 100))}"] if r.low is not None else []
        parts += [f"{r.numerator} * 100 > {over} * {int(round(r.high * 100))}"] if r.high is not None else []
        return f"(({' OR '.join(parts)}) AND {over} > 0 AND n_words >= {r.words})"
    base = " OR ".join(cond(r) for r in rules if r.name in BASE)
    names = ", ".join(f"CASE WHEN {cond(r)} THEN '{r.name}' END" for r in rules)
    return base, f"concat_ws(',', {names})"
