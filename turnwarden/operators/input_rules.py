"""Rules over a user's text that need nothing but the row: no shuffle, one pass, any number of rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.gates import all_labels, any_may_match, first_label, holds_any, may_link
from turnwarden.functions.links import untrusted_links
from turnwarden.functions.patterns import count_matches, java_pattern, literal
from turnwarden.functions.text import let, percent, rewrite_matches, stars
from turnwarden.operators.decisions import Step, alive, record_all, rewrite, start
from turnwarden.operators.dictionary import DIGEST, Dictionary, join_back

# ---------------------------------------------------------------------------------------------- 1 keywords


def _keyword_patterns(terms: Sequence[str], boundary: bool) -> list[tuple[str, str]]:
    return [(t, java_pattern((r"\b" if boundary else "") + literal(t.lower()))) for t in terms]


def lowered() -> Column:
    return F.col("_lower")


def lower_helper(text: Column) -> dict[str, Column]:
    """The lower-cased text, which most rules read many times."""
    return {"_lower": F.lower(text)}


def keyword_steps(terms: Sequence[str] = tuple(fixed.BANNED_KEYWORDS), boundary: bool = True) -> list[Step]:
    """Reads ``_lower``."""
    term = F.coalesce(*[F.when(lowered().contains(t.lower()) & lowered().rlike(p), F.lit(t))
                        for t, p in _keyword_patterns(terms, boundary)])
    return [Step(1, "Keyword filter", "blocked", F.concat(F.lit("banned keyword: '"), term, F.lit("'")))]


def keyword_screen(df: DataFrame, terms: Sequence[str] = tuple(fixed.BANNED_KEYWORDS), boundary: bool = True,
                   text: str = "text") -> DataFrame:
    """Block texts holding a banned term. A term must start at a word start and may run on ("weapon" in "weapons");
    ``boundary=False`` is the plain substring test. The first term of the list is reported."""
    return record_all(df, keyword_steps(terms, boundary), lower_helper(F.col(text)))


def keyword_screen_table(df: DataFrame, terms: DataFrame, boundary: bool = True, text: str = "text") -> DataFrame:
    """``keyword_screen`` with the terms of a table (ord, term) of any size; of those found the one with the least ``ord`` is
    reported."""
    entries = terms.select("ord", F.lower("term").alias("term"), F.col("term").alias("_shown"))
    low = F.lower(F.col(text))
    first = Dictionary(entries, at_words=boundary).found(df, low).groupBy(*DIGEST).agg(F.min(F.struct("ord", "_shown")).alias("_first"))
    df = join_back(start(df), low, first)
    detail = F.concat(F.lit("banned keyword: '"), F.col("_first._shown"), F.lit("'"))
    return record_all(df, [Step(1, "Keyword filter", "blocked", detail)]).drop("_first")


def keyword_hits(df: DataFrame, terms: Sequence[str] = tuple(fixed.BANNED_KEYWORDS), boundary: bool = True,
                 text: str = "text") -> DataFrame:
    """Texts and occurrences per term; aggregated before the shuffle, one row per term leaves each task."""
    patterns = _keyword_patterns(terms, boundary)
    hits = F.array(*[F.when(lowered().contains(t.lower()), F.struct(
        F.lit(t).alias("term"), count_matches(lowered(), p).alias("n"))) for t, p in patterns])
    return (df.select(F.lower(F.col(text)).alias("_lower")).filter(holds_any(lowered(), [t.lower() for t in terms]))
            .select(F.explode(hits).alias("h")).filter("h.n > 0")
            .groupBy(F.col("h.term").alias("term"))
            .agg(F.count("*").alias("texts"), F.sum("h.n").alias("hits")))


# ---------------------------------------------------------------------------------------------- 2 injection

def injection_steps(text: Column, patterns: Sequence[str] = tuple(fixed.INJECTION_PATTERNS)) -> list[Step]:
    """Reads ``_lower``."""
    hit = first_label(text, [(p, p) for p in patterns], True, lowered())
    return [Step(2, "Prompt injection (regex)", "blocked", F.concat(F.lit("pattern: "), hit))]


def injection_screen(df: DataFrame, patterns: Sequence[str] = tuple(fixed.INJECTION_PATTERNS),
                     text: str = "text") -> DataFrame:
    """Block well-known attempts to override the instructions; the first matching pattern is reported."""
    return record_all(df, injection_steps(F.col(text), patterns), lower_helper(F.col(text)))


def injection_phrase_screen(df: DataFrame, phrases: Sequence[str] = tuple(fixed.INJECTION_PHRASES),
                            text: str = "text") -> DataFrame:
    """The phrase-list baseline: plain substrings of the lower-cased text."""
    hit = F.coalesce(*[F.when(lowered().contains(p), F.lit(p)) for p in phrases])
    return record_all(df, [Step(2, "Prompt injection (phrases)", "blocked", F.concat(F.lit("phrase: "), hit))],
                      lower_helper(F.col(text)))


# ---------------------------------------------------------------------------------------------- 4 length

def length_steps(text: Column, max_chars: int = fixed.MAX_INPUT_CHARS) -> list[Step]:
    n = F.length(text)
    detail = F.when(n > max_chars, F.concat(n.cast("string"), F.lit(f" chars > {max_chars}")))
    return [Step(4, "Input length limit", "blocked", detail)]


def length_screen(df: DataFrame, max_chars: int = fixed.MAX_INPUT_CHARS, text: str = "text") -> DataFrame:
    """Block texts longer than ``max_chars`` characters."""
    return record_all(df, length_steps(F.col(text), max_chars))


# ---------------------------------------------------------------------------------------------- 5, 6 PII

def _pii_patterns(builtin: Sequence[str] | None, custom: Sequence[tuple[str, str]]):
    return [(n, p) for n, p in fixed.INPUT_PII_PATTERNS if builtin is None or n in builtin], list(custom)


def _pii_found(text: Column, patterns: Sequence[tuple[str, str]], prefix: str) -> Column:
    if not patterns:
        return F.lit(None).cast("string")
    labels = F.array(*[F.when(text.rlike(java_pattern(p)), F.lit(n)) for n, p in patterns])
    return F.when(F.col("_pii"), F.concat(F.lit(prefix), F.nullif(F.array_join(labels, ", "), F.lit(""))))


def pii_steps(text: Column, builtin: Sequence[str] | None = None,
              custom: Sequence[tuple[str, str]] = ()) -> list[Step]:
    """Reads ``_pii``."""
    own, extra = _pii_patterns(builtin, custom)
    return [Step(5, "PII masking", "modified", _pii_found(text, own, "masked: ")),
            Step(6, "Custom PII patterns", "modified", _pii_found(text, extra, "masked: "))]


def pii_masked(text: Column, builtin: Sequence[str] | None = None, custom: Sequence[tuple[str, str]] = ()) -> Column:
    """``text`` with the matches of every kind found in it starred out, kind after kind."""
    def starred(so_far: Column, pattern: str) -> Column:
        return let(so_far, lambda t: F.when(text.rlike(pattern), rewrite_matches(t, pattern, stars)).otherwise(t))

    return reduce(starred, [java_pattern(p) for _, p in sum(_pii_patterns(builtin, custom), [])], text)


def pii_helper(text: Column, builtin: Sequence[str] | None = None,
               custom: Sequence[tuple[str, str]] = ()) -> dict[str, Column]:
    """Whether the text may hold personal data at all."""
    return {"_pii": any_may_match(text, [p for _, p in sum(_pii_patterns(builtin, custom), [])])}


def pii_recorded() -> Column:
    return F.exists("decisions", lambda e: e["number"].isin(5, 6))


def pii_screen(df: DataFrame, builtin: Sequence[str] | None = None,
               custom: Sequence[tuple[str, str]] = (), mode: str = "mask", text: str = "text") -> DataFrame:
    """Mask personal data with as many asterisks as it has characters, or block the text (``mode="block"``).

    ``builtin`` names the built-in detectors to use (default all), ``custom`` adds ``(name, pattern)`` detectors. What
    is found is decided on the text as it came; masking then runs detector by detector. Built-in and custom finds are
    two decisions.
    """
    t = F.col(text)
    if mode == "block":
        found = _pii_found(t, sum(_pii_patterns(builtin, custom), []), "detected: ")
        return record_all(df, [Step(5, "PII masking", "blocked", found)], pii_helper(t, builtin, custom))
    df = record_all(df, pii_steps(t, builtin, custom), pii_helper(t, builtin, custom))
    return rewrite(df, text, alive() & pii_recorded(), pii_masked(t, builtin, custom))


# ---------------------------------------------------------------------------------------------- 16 crisis

def crisis_signal_steps(signals: Sequence[str] = tuple(fixed.CRISIS_SIGNALS)) -> list[Step]:
    """Reads ``_lower``."""
    hit = F.coalesce(*[F.when(lowered().contains(s), F.lit(s)) for s in signals])
    return [Step(16, "Crisis safe completion", "blocked", F.concat(F.lit("signal: '"), hit, F.lit("'")))]


def crisis_signal_screen(df: DataFrame, signals: Sequence[str] = tuple(fixed.CRISIS_SIGNALS),
                         text: str = "text") -> DataFrame:
    """Block texts holding a self-harm phrase, as a plain substring of the lower-cased text."""
    return record_all(df, crisis_signal_steps(signals), lower_helper(F.col(text)))


# ---------------------------------------------------------------------------------------------- 19 invisible text

_LATER = "".join("-".join(rf"\x{{{end}}}" for end in r.split("-")) for r in fixed.ASSIGNED_LATER)
HIDDEN = rf"[\p{{Cf}}\p{{Co}}\x{{E0000}}-\x{{E007F}}[\p{{Cn}}&&[^{_LATER}]]]"
TAG = r"[\x{E0000}-\x{E007F}]"
TAG_BASE = 0xE0000


def _quoted_payload(text: Column) -> Column:
    """The ASCII spelled by the tag characters of ``text``, quoted and escaped as a string literal."""
    tags = F.regexp_extract_all(text, F.lit(TAG), F.lit(0))
    shown = F.array(*[F.lit("'" if chr(i) == "'" else repr(chr(i))[1:-1]) for i in range(128)])
    body = F.array_join(F.transform(tags, lambda c: F.element_at(shown, F.ascii(c) - F.lit(TAG_BASE - 1))), "")
    single, double = body.contains("'"), body.contains('"')
    return (F.when(single & ~double, F.concat(F.lit('"'), body, F.lit('"')))
            .otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))))


def may_hide(text: Column) -> Column:
    """Only texts beyond ASCII can hold invisible characters."""
    return F.octet_length(text) != F.length(text)


def invisible_text_steps(text: Column, strip: bool = True) -> list[Step]:
    hidden = may_hide(text) & text.rlike(HIDDEN)
    payload = F.when(hidden & text.rlike(TAG), F.concat(F.lit("hidden payload: "), _quoted_payload(text)))
    if not strip:
        return [Step(19, "Invisible text", "blocked", F.coalesce(payload, F.when(hidden, F.lit("hidden characters"))))]
    kinds = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(HIDDEN), F.lit(0))))
    note = F.when(hidden, F.concat(F.lit("stripped "), kinds.cast("string"), F.lit(" invisible character type(s)")))
    return [Step(19, "Invisible text", "blocked", payload), Step(19, "Invisible text", "modified", note)]


def visible(text: Column) -> Column:
    return F.regexp_replace(text, HIDDEN, "")


def invisible_text_screen(df: DataFrame, strip: bool = True, text: str = "text") -> DataFrame:
    """Block texts that carry a payload in tag characters; strip other invisible characters (or block them)."""
    t = F.col(text)
    df = record_all(df, invisible_text_steps(t, strip))
    return rewrite(df, text, alive() & may_hide(t), visible(t)) if strip else df


# ---------------------------------------------------------------------------------------------- 20 secrets

def secrets_steps(text: Column, patterns: Sequence[tuple[str, str]] = tuple(fixed.SECRET_PATTERNS)) -> list[Step]:
    """Reads ``_lower``."""
    found = F.array_join(all_labels(text, patterns, lowered()), ", ")
    return [Step(20, "Secrets detection", "blocked", F.concat(F.lit("found: "), F.nullif(found, F.lit(""))))]


def secrets_screen(df: DataFrame, patterns: Sequence[tuple[str, str]] = tuple(fixed.SECRET_PATTERNS),
                   text: str = "text") -> DataFrame:
    """Block texts holding a credential; all kinds found are listed."""
    return record_all(df, secrets_steps(F.col(text), patterns), lower_helper(F.col(text)))


# ---------------------------------------------------------------------------------------------- 22 gibberish

ASCII_WORD = "[A-Za-z]+"
# A run of letters of at least four that has no vowel, five consonants in a row, or one letter four times in a row.
GIBBERISH_WORD = (r"(?i)(?<![a-z])(?=[a-z]{4})"
                  r"(?:(?=[b-df-hj-np-tv-xz]++(?![a-z]))|(?=[a-z]*?[b-df-hj-np-tv-xz]{5})|(?=[a-z]*?([a-z])\1{3}))"
                  r"[a-z]+")
# Every such word holds one of these, so counting them bounds the number of such words from above.
CONSONANT_RUN = "[B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz]{4}"
VOWEL_RUN = "[Aa]{4}|[Ee]{4}|[Ii]{4}|[Oo]{4}|[Uu]{4}|[Yy]{4}"
FLOOD_CHARS, FLOOD_SHARE = 20, 0.4


def gibberish_helpers(text: Column) -> dict[str, Column]:
    """Bounds and counts the rule reads more than once."""
    return {"_odd": F.when(F.length(text) >= FLOOD_CHARS, F.length(F.regexp_replace(text, "[A-Za-z0-9 ]+", ""))),
            "_words": count_matches(text, ASCII_WORD), "_signs": count_matches(text, CONSONANT_RUN)}


def gibberish_steps(text: Column, max_ratio: float = 0.5, min_words: int = 3) -> list[Step]:
    """Reads ``_lower`` and the helpers."""
    chars = F.length(text)
    symbols = F.length(F.regexp_replace(text, r"(?U)[\p{L}\p{N}\s\x1c-\x1f]+", ""))
    flood = (F.col("_odd") > FLOOD_SHARE * chars) & (symbols / F.nullif(chars, F.lit(0)) > FLOOD_SHARE)
    vowels = F.when(holds_any(lowered(), [v * 4 for v in "aeiouy"]), count_matches(text, VOWEL_RUN)).otherwise(0)
    open_case = (F.col("_words") >= min_words) & (F.col("_signs") + vowels > max_ratio * F.col("_words"))
    ratio = count_matches(text, GIBBERISH_WORD) / F.nullif(F.col("_words"), F.lit(0))
    detail = (F.when(flood, F.lit("mostly symbols"))
              .when(open_case & (ratio > max_ratio), F.concat(percent(ratio).cast("string"), F.lit("% gibberish words"))))
    return [Step(22, "Gibberish detection", "blocked", detail)]


def gibberish_screen(df: DataFrame, max_ratio: float = 0.5, min_words: int = 3, text: str = "text") -> DataFrame:
    """Block symbol floods and keyboard mash.

    Both measures are first bounded by a cheaper one (characters outside plain letters and digits; signs of a mashed
    word), and measured exactly only where the bound leaves the outcome open.
    """
    t = F.col(text)
    return record_all(df, gibberish_steps(t, max_ratio, min_words), lower_helper(t) | gibberish_helpers(t))


# ---------------------------------------------------------------------------------------------- 23 links

def url_steps(text: Column, domains: Sequence[str] = tuple(fixed.TRUSTED_DOMAINS), strict: bool = False) -> list[Step]:
    """Reads ``_lower``."""
    bad = F.when(may_link(text, lowered()), F.array_join(untrusted_links(text, domains, strict), ", "))
    return [Step(23, "URL allowlist (input)", "blocked", F.concat(F.lit("blocked: "), F.nullif(bad, F.lit(""))))]


def url_screen(df: DataFrame, domains: Sequence[str] = tuple(fixed.TRUSTED_DOMAINS), strict: bool = False,
               text: str = "text") -> DataFrame:
    """Block texts with a link outside the allow-list; every such link is listed in order."""
    return record_all(df, url_steps(F.col(text), domains, strict), lower_helper(F.col(text)))
