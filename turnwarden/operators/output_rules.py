"""Rules over an answer that need nothing but the row. They rewrite and report; none of them blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.gates import any_match, any_may_match, holds_any, may_link
from turnwarden.functions.links import redact_untrusted, untrusted_links
from turnwarden.functions.patterns import any_of, count_matches, java_pattern, literal
from turnwarden.functions.text import keep_first_char, let, lines, rewrite_matches
from turnwarden.operators import matching
from turnwarden.operators.decisions import record, rewrite, start
from turnwarden.operators.dictionary import DIGEST, Dictionary, join_back


def _replace_in_turn(df: DataFrame, text: str, steps: Sequence[tuple[str, str, str]],
                     possible: Callable[[Column, Column], Column]) -> DataFrame:
    """Replace pattern after pattern, each on the text the one before left: ``_done`` holds the text and a count per
    pattern. ``possible`` (of the text and its lower case) is false only for texts without any match; those have no
    ``_done``.
    """
    def replaced(so_far: Column, step: tuple[str, str, str]) -> Column:
        _, pattern, replacement = step
        return let(so_far, lambda s: F.struct(
            F.regexp_replace(s["text"], pattern, replacement).alias("text"),
            F.concat(s["n"], F.array(count_matches(s["text"], pattern))).alias("n")))

    untouched = F.struct(F.col(text).alias("text"), F.array().cast("array<int>").alias("n"))
    df = start(df).withColumn("_lower", F.lower(F.col(text)))
    may = possible(F.col(text), F.col("_lower"))
    return df.withColumn("_done", F.when(may, reduce(replaced, steps, untouched))).drop("_lower")


def _finish(df: DataFrame, text: str, number: int, name: str, detail: Column) -> DataFrame:
    df = record(df, number, name, "modified", detail)
    return rewrite(df, text, F.col("_done").isNotNull(), F.col("_done")["text"]).drop("_done")


def _n(i: int) -> Column:
    return F.col("_done")["n"][i]


def _listed(parts: list[Column], prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.nullif(F.array_join(F.array(*parts), ", "), F.lit("")))


def pii_redact(df: DataFrame, patterns: Sequence[tuple[str, str]] = tuple(fixed.OUTPUT_PII_PATTERNS),
               text: str = "text", counts: bool = False) -> DataFrame:
    """Replace personal data by its label, most specific kind first. ``counts=True`` keeps one count column per kind."""
    steps = [(label, java_pattern(p), f"[REDACTED_{label}]") for label, p in patterns]
    df = _replace_in_turn(df, text, steps, lambda t, low: any_match(t, [p for _, p in patterns], low))
    parts = [F.when(_n(i) > 0, F.concat(_n(i).cast("string"), F.lit(f" {label}"))) for i, (label, _, _) in enumerate(steps)]
    if counts:
        df = df.withColumns({f"n_{label.lower()}": F.coalesce(_n(i), F.lit(0)) for i, (label, _, _) in enumerate(steps)})
    return _finish(df, text, 27, "Output PII redaction", _listed(parts, "redacted: "))


def secrets_redact(df: DataFrame, patterns: Sequence[tuple[str, str]] = tuple(fixed.SECRET_PATTERNS),
                   text: str = "text") -> DataFrame:
    """Replace credentials by their kind, list order; an earlier label can hide a later match."""
    steps = [(n, java_pattern(p), f"[REDACTED_{n.upper().replace(' ', '_')}]") for n, p in patterns]
    df = _replace_in_turn(df, text, steps, lambda t, low: any_match(t, [p for _, p in patterns], low))
    parts = [F.when(_n(i) > 0, F.lit(n)) for i, (n, _, _) in enumerate(steps)]
    return _finish(df, text, 20, "Secrets detection", _listed(parts, "redacted: "))


def url_redact(df: DataFrame, domains: Sequence[str] = tuple(fixed.TRUSTED_DOMAINS), strict: bool = False,
               text: str = "text") -> DataFrame:
    """Replace each link outside the allow-list where it stands; the distinct ones are listed, leftmost first."""
    bad = F.array_join(F.array_distinct(untrusted_links(F.col(text), domains, strict)), ", ")
    df = start(df).withColumn("_lower", F.lower(F.col(text)))
    df = df.withColumn("_bad", F.when(may_link(F.col(text), F.col("_lower")), bad)).drop("_lower")
    df = record(df, 23, "URL allowlist (output)", "modified",
                F.when(F.col("_bad") != "", F.concat(F.lit("removed: "), F.col("_bad"))))
    return rewrite(df, text, F.col("_bad") != "", redact_untrusted(F.col(text), domains, strict)).drop("_bad")


def dangerous_code_filter(df: DataFrame, patterns: Sequence[str] = tuple(fixed.DANGEROUS_CODE_PATTERNS),
                          text: str = "text") -> DataFrame:
    """Replace every line holding a destructive command and append a warning.

    A line can only match if the text does, so other texts are never cut into lines.
    """
    merged = any_of(patterns, ignore_case=True)
    df = start(df).withColumn("_lower", F.lower(F.col(text)))
    possible = any_may_match(F.col(text), patterns, True, F.col("_lower")) & F.col(text).rlike(merged)
    df = df.withColumn("_lines", F.when(possible, lines(F.col(text))))
    df = df.withColumn("_kept", F.transform(
        "_lines", lambda ln: F.when(ln.rlike(merged), F.lit(fixed.COMMAND_MASK)).otherwise(ln)))
    changed = F.zip_with("_kept", "_lines", lambda a, b: a != b)
    df = df.withColumn("_n", F.coalesce(F.size(F.filter(changed, lambda c: c)), F.lit(0)))
    df = record(df, 28, "Dangerous code filter", "modified",
                F.when(F.col("_n") > 0, F.concat(F.lit("removed "), F.col("_n").cast("string"), F.lit(" line(s)"))))
    rewritten = F.concat(F.array_join("_kept", "\n"), F.lit(fixed.COMMAND_WARNING))
    return rewrite(df, text, F.col("_n") > 0, rewritten).drop("_lines", "_kept", "_n", "_lower")


def profanity_mask(df: DataFrame, stems: Sequence[str] = tuple(fixed.PROFANITY_STEMS), text: str = "text",
                   counts: bool = False) -> DataFrame:
    """Mask words that start with a listed stem: the first character stays, the rest become asterisks."""
    pattern = java_pattern(r"\b(?:" + "|".join(literal(s) for s in stems) + r")\w*", ignore_case=True)
    df = start(df).withColumn("_lower", F.lower(F.col(text)))
    possible = holds_any(F.col(text), [s.lower() for s in stems], True, F.col("_lower"))
    df = df.withColumn("_n", F.when(possible, count_matches(F.col(text), pattern)).otherwise(0)).drop("_lower")
    df = record(df, 29, "Toxicity filter", "modified",
                F.when(F.col("_n") > 0, F.concat(F.lit("masked "), F.col("_n").cast("string"), F.lit(" word(s)"))))
    df = rewrite(df, text, F.col("_n") > 0, rewrite_matches(F.col(text), pattern, keep_first_char))
    return df.withColumnRenamed("_n", "masked_words") if counts else df.drop("_n")


def marker_leak_redact(df: DataFrame, markers: Sequence[str] = tuple(fixed.LEAK_MARKERS),
                       text: str = "text") -> DataFrame:
    """Replace internal markers (exact case); the report counts markers found, not occurrences."""
    leaked = sum((F.col(text).contains(m).cast("int") for m in markers), F.lit(0))
    df = start(df).withColumn("_n", leaked)
    cleaned = F.col(text)
    for m in markers:
        cleaned = F.replace(cleaned, F.lit(m), F.lit(fixed.LEAK_MASK))
    df = record(df, 9, "System-prompt leak guard", "modified",
                F.when(F.col("_n") > 0, F.concat(F.lit("redacted "), F.col("_n").cast("string"),
                                                 F.lit(" internal marker(s)"))))
    return rewrite(df, text, F.col("_n") > 0, cleaned).drop("_n")


def brand_scrub(df: DataFrame, terms: Sequence[str] = tuple(fixed.COMPETITORS),
                replacement: str = fixed.BRAND_MASK, text: str = "text") -> DataFrame:
    """Replace competitor names, whole words in any case, in list order."""
    steps = [(t, java_pattern(r"\b" + literal(t) + r"\b", ignore_case=True), replacement.replace("$", r"\$"))
             for t in terms]
    df = _replace_in_turn(df, text, steps, lambda t, low: holds_any(t, [x.lower() for x in terms], True, low))
    parts = [F.when(_n(i) > 0, F.lit(t)) for i, (t, _, _) in enumerate(steps)]
    return _finish(df, text, 15, "Brand safety", _listed(parts, "scrubbed: "))


def brand_scrub_table(df: DataFrame, terms: DataFrame, replacement: str = fixed.BRAND_MASK, text: str = "text") -> DataFrame:
    """``brand_scrub`` with the names of a table (ord, term) of any size. All names are looked for in the text as it came; where
    names overlap, the one that begins first and of those the longest is replaced. The report lists names found, by ``ord``."""
    entries = terms.filter("term <> ''").select("ord", F.lower("term").alias("term"), F.col("term").alias("shown"))
    low = F.lower(F.col(text))
    entries, table = matching.held(entries)
    if table is not None:
        df = start(df)
        df = df.withColumn("_scrubbed", matching.scrubbed_in(df, table, F.col(text), low, replacement))
        df = record(df, 15, "Brand safety", "modified", F.concat(F.lit("scrubbed: "), F.col("_scrubbed.listed")))
        return rewrite(df, text, F.col("_scrubbed.listed").isNotNull(), F.col("_scrubbed.text")).drop("_scrubbed")
    quoted = F.regexp_replace("term", r"([\\^$.|?*+()\[\]{}\-&~#])", r"\\$1")
    by_length = F.array_sort(F.collect_set(F.struct((-F.length("term")).alias("n"), quoted.alias("q"))))
    shown = F.array_distinct(F.transform(F.array_sort(F.collect_set(F.struct("ord", "shown"))), lambda e: e["shown"]))
    found = Dictionary(entries, whole_words=True).found(df, low).groupBy(*DIGEST).agg(
        F.concat(F.lit(r"(?iU)\b(?:"), F.array_join(F.transform(by_length, lambda e: e["q"]), "|"), F.lit(r")\b")).alias("_names"),
        F.array_join(shown, ", ").alias("_listed"))
    df = join_back(start(df), low, found)
    df = record(df, 15, "Brand safety", "modified", F.concat(F.lit("scrubbed: "), F.col("_listed")))
    scrubbed = F.regexp_replace(F.col(text), F.col("_names"), F.lit(replacement.replace("\\", r"\\").replace("$", r"\$")))
    return rewrite(df, text, F.col("_names").isNotNull(), scrubbed).drop("_names", "_listed")


def append_disclaimer(df: DataFrame, needle: str = fixed.DISCLAIMER_NEEDLE, suffix: str = fixed.DISCLAIMER,
                      text: str = "text") -> DataFrame:
    """End every non-empty answer that lacks it with the disclaimer."""
    t = F.col(text)
    return rewrite(df, text, (t != "") & ~F.lower(t).contains(needle), F.concat(t, F.lit(suffix)))


def token_budget(df: DataFrame, max_tokens: int = fixed.TOKEN_BUDGET, text: str = "text") -> DataFrame:
    """Estimated tokens of each answer (white-space separated words) and whether they exceed the cap."""
    words = count_matches(F.col(text), r"\S+")
    return df.withColumns({"tokens": words}).withColumn("over_budget", F.col("tokens") > max_tokens)
