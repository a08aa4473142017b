"""The ordered stacks.

Rules are listed in the order that decides which one is reported and which text the later ones see. Physically a stack
is: joins of one narrow row per turn (admission, language, verdicts), all on the turn key, followed by one pass over
the row in which every rule only acts on rows still alive. Cheap rules never wait for a shuffle of the text, and the
text is shuffled once however many judgements are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import input_rules as inp
from turnwarden.operators import output_rules as out
from turnwarden.operators import verdict_rules as ver
from turnwarden.operators.decisions import Step, alive, record_all, rewrite, start
from turnwarden.operators.grounding import grounding_check
from turnwarden.operators.language import LanguageModel, language_steps, with_language
from turnwarden.operators.ordered import GROUP_ROWS
from turnwarden.operators.rate_limit import rate_limit_screen
from turnwarden.plans.registry import MASKED, RAW, VISIBLE, Rule, placed, prepared


@dataclass(frozen=True)
class InputSettings:
    """Parameters of the input stack; the defaults are the documented ones. ``skip`` leaves rules out, ``own`` adds rules, and without
    ``crisis_judge`` rule 16 goes by its signals alone."""
    max_requests: int = fixed.RATE_MAX_REQUESTS
    window_seconds: float = fixed.RATE_WINDOW_SECONDS
    max_chars: int = fixed.MAX_INPUT_CHARS
    languages: Sequence[str] = tuple(fixed.ALLOWED_LANGUAGES)
    language_min_chars: int = fixed.LANGUAGE_MIN_CHARS
    language_min_confidence: float = fixed.LANGUAGE_MIN_CONFIDENCE
    custom_pii: Sequence[tuple[str, str]] = tuple(fixed.CUSTOM_PII_PATTERNS)
    keywords: Sequence[str] = tuple(fixed.BANNED_KEYWORDS)
    domains: Sequence[str] = tuple(fixed.TRUSTED_DOMAINS)
    attack_threshold: float = fixed.ATTACK_THRESHOLD
    group_rows: int = GROUP_ROWS
    crisis_judge: bool = True
    skip: Sequence[int] = ()
    own: Sequence[Rule] = ()


def screen_input(turns: DataFrame, verdicts: DataFrame | None = None, language: LanguageModel | None = None,
                 settings: InputSettings = InputSettings(), key: str = "turn_id", user: str = "user_id",
                 ts: str = "ts", text: str = "text") -> DataFrame:
    """Run the input stack over turns: adds ``decisions`` and ``blocked_by`` and rewrites ``text``.

    Order: 26 rate limit, 4 length, 19 invisible text, 22 gibberish, 21 language, 16 crisis, 2 injection, 20 secrets,
    5/6 personal data, 1 keywords, 23 links, 18 prompt attack, 3 topic, 7 moderation.
    """
    s = settings

    def on(number: int) -> bool:
        return number not in s.skip

    df = start(turns)
    if on(26):
        df = rate_limit_screen(df, key, user, ts, s.max_requests, s.window_seconds, s.group_rows)
    judged = [n for n in (16, 18, 3, 7) if on(n)]
    if judged:
        df = ver.join_verdicts(df, verdicts, key)
    return ver.drop_verdicts(judged_input(df, s, language, text)).drop("_language", "_p")


def judged_input(df: DataFrame, settings: InputSettings = InputSettings(), language: LanguageModel | None = None, text: str = "text") -> DataFrame:
    """The stack behind admission, over turns that carry their verdict columns. Needs only the row, so it runs on a stream too."""
    s, t = settings, F.col(text)

    def on(number: int) -> bool:
        return number not in s.skip

    scored = language if on(21) else None
    confident = [] if scored is None else language_steps(t, s.languages, s.language_min_chars, s.language_min_confidence)
    judge = ver.crisis_judge_steps() if on(16) and s.crisis_judge else []
    last = (ver.prompt_attack_steps() if on(18) else []) + (ver.topical_steps() if on(3) else []) \
        + (ver.moderation_steps() if on(7) else [])
    helpers = ver.prompt_attack_helpers(t, s.attack_threshold) if on(18) else {}
    return _text_rules(start(df), s, text, confident, judge, last, helpers, scored)


def _text_rules(df: DataFrame, s: InputSettings, text: str, after_gibberish: list[Step], after_signals: list[Step], after_links: list[Step],
                last_helpers: dict[str, Column], language: LanguageModel | None = None) -> DataFrame:
    """The row-local stack: three rounds of steps, because the text changes twice (stripped, then masked). Languages are told for
    rows that are alive and long enough."""
    t = F.col(text)

    def chosen(*groups: list[Step]) -> list[Step]:
        return [step for group in groups for step in group if step.number not in s.skip]

    kept = [*df.columns, "_language", "_p"]
    df, own = prepared(df, s.own, RAW, text)
    raw = placed(chosen(inp.length_steps(t, s.max_chars), inp.invisible_text_steps(t)), own)
    if raw:
        df = record_all(df, raw)
    if 19 not in s.skip:
        df = rewrite(df, text, alive() & inp.may_hide(t), inp.visible(t))
    if language is not None:
        df = with_language(df, language, F.when(alive() & (F.length(t) >= s.language_min_chars), t))
    df, own = prepared(df, s.own, VISIBLE, text)
    seen = placed(chosen(inp.gibberish_steps(t), after_gibberish, inp.crisis_signal_steps(), after_signals, inp.injection_steps(t),
                         inp.secrets_steps(t), inp.pii_steps(t, custom=s.custom_pii)), own)
    if seen:
        helpers = inp.lower_helper(t) | inp.pii_helper(t, custom=s.custom_pii)
        df = record_all(df, seen, helpers if 22 in s.skip else helpers | inp.gibberish_helpers(t))
    if 5 not in s.skip or 6 not in s.skip:
        df = rewrite(df, text, alive() & inp.pii_recorded(), inp.pii_masked(t, custom=s.custom_pii))
    df, own = prepared(df, s.own, MASKED, text)
    masked = placed(chosen(inp.keyword_steps(s.keywords), inp.url_steps(t, s.domains), after_links), own)
    if masked:
        df = record_all(df, masked, inp.lower_helper(t) | last_helpers)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])


def deterministic_input(df: DataFrame, settings: InputSettings = InputSettings(), text: str = "text") -> DataFrame:
    """The rules of the input stack that need only the row: also the form that runs unchanged on a stream."""
    return _text_rules(start(df), settings, text, [], [], [], {})


def screen_output(answers: DataFrame, verdicts: DataFrame | None = None, contexts: DataFrame | None = None,
                  claims: DataFrame | None = None, question: str | None = "question", judged: bool = True,
                  domains: Sequence[str] = tuple(fixed.TRUSTED_DOMAINS), key: str = "turn_id",
                  text: str = "text") -> DataFrame:
    """Run the output stack over answers; every rule may rewrite the text, none of them changes the verdict.

    Order: 27 personal data, 20 secrets, 23 links, 28 commands, 29 profanity, 9 markers, 15 brands, then the judged
    rules 7, 12, 14, 30 and the disclaimer.
    """
    df = out.pii_redact(start(answers), text=text)
    df = out.secrets_redact(df, text=text)
    df = out.url_redact(df, domains, text=text)
    df = out.dangerous_code_filter(df, text=text)
    df = out.profanity_mask(df, text=text)
    df = out.marker_leak_redact(df, text=text)
    df = out.brand_scrub(df, text=text)
    if judged:
        df = ver.join_verdicts(df, verdicts, key)
        df = ver.moderation_replace(df, text=text, key=key)
        df = ver.policy_judge(df, text=text, key=key)
    if contexts is not None:
        df = grounding_check(df, contexts, claims, key, text=text)
    if judged and question is not None:
        df = ver.relevance_check(df, question=question, text=text, key=key)
    return out.append_disclaimer(ver.drop_verdicts(df), text=text)


def turn_verdict(status: Column, messages: Column) -> Column:
    """Verdict of a finished run from its status and number of messages.

    An error before any message was built is a block; a later one is an error; rewritten answers stay allowed.
    """
    return (F.when((status == "error") & (F.coalesce(messages, F.lit(0)) == 0), F.lit("BLOCKED"))
            .when(status == "error", F.lit("ERROR")).when(status == "paused", F.lit("PAUSED"))
            .otherwise(F.lit("ALLOWED")))


def screened_verdict(paused: Column | None = None, failed: Column | None = None) -> Column:
    """Verdict of a screened row: blocked input first, then a failed run, then calls that wait for a human."""
    verdict = F.when(F.col("blocked_by").isNotNull(), F.lit("BLOCKED"))
    if failed is not None:
        verdict = verdict.when(failed, F.lit("ERROR"))
    if paused is not None:
        verdict = verdict.when(paused, F.lit("PAUSED"))
    return verdict.otherwise(F.lit("ALLOWED"))


def block_reply(df: DataFrame) -> DataFrame:
    """Add what a blocked user is told (``reply``) and the trigger reported (``trigger``)."""
    def ladder(table: dict[int, str]) -> Column:
        return F.coalesce(*[F.when(F.col("blocked_by") == n, F.lit(t)) for n, t in table.items()])
    return df.withColumns({"reply": ladder(fixed.BLOCK_MESSAGES), "trigger": ladder(fixed.BLOCK_TRIGGERS)})


def latency_ms(started: Column, finished: Column) -> Column:
    """Whole milliseconds between start and finish."""
    return F.unix_millis(finished) - F.unix_millis(started)
