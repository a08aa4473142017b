"""Cheap tests that a text must pass before a pattern can match it.

Most texts hold none of the things a rule looks for, and a substring search costs a small part of a pattern search. A
gate lists substrings of which any match of the pattern needs one from every group; it never decides a hit, it only
saves the pattern from being tried. Patterns without a gate are tried as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.patterns import java_pattern

# Letters outside ASCII that equal an ASCII letter when case is ignored, but not once lower-cased.
FOLDED = ["ſ", "K", "İ", "ı"]
THREE_DIGITS = r"\p{Nd}{3}"
DIGITS = "digits"
LINK_STARTS = ["http:", "https:", "ftp:", "file:", "javascript:", "data:"]

GATES: dict[str, list[list[str]]] = dict(zip(fixed.INJECTION_PATTERNS, [
    [["ignore"], ["previous", "prior", "above"]],
    [["disregard"]],
    [["you"], ["now"]],
    [["developer"], ["mode"]],
    [["dan"]],
    [["reveal"]],
    [["what"], ["prompt", "instructions"]],
    [["print"], ["prompt", "instructions"]],
    [["override"]],
]))
GATES |= dict(zip(fixed.INDIRECT_PATTERNS, [
    [["ignore"], ["instructions"]],
    [["disregard"]],
    [["you"], ["now"]],
    [["new"], ["instructions"]],
    [["password", "credentials", "api", "insurance"], ["send", "email", "share"]],
    [["not"], ["the"], ["user"]],
    [["<"], ["system", "instruction"], [">"]],
]))
GATES |= dict(zip(fixed.DANGEROUS_CODE_PATTERNS, [
    [["rm"], ["-"], ["/", "~", "*", "$home"]],
    [["curl", "wget"], ["|"]],
    [[":()"]],
    [["mkfs"]],
    [["if="], ["of="]],
    [["chmod"]],
    [["powershell"]],
    [["invoke-expression", "iex"]],
    [["format"], ["c:"]],
]))
GATES |= {p: [[DIGITS]] for n, p in fixed.OUTPUT_PII_PATTERNS if n != "EMAIL"}
GATES |= {p: [["@"]] for n, p in fixed.OUTPUT_PII_PATTERNS if n == "EMAIL"}
GATES |= {p: [[n]] for (_, p), n in zip(fixed.CUSTOM_PII_PATTERNS, ["INS", "MRN"])}
GATES |= {p: [[DIGITS]] for _, p in fixed.REGIONAL_PII_PATTERNS}
GATES |= dict(zip([p for _, p in fixed.SECRET_PATTERNS], [
    [["sk-"]], [["gsk_"]], [["AKIA"]], [["ghp_", "gho_", "ghu_", "ghs_", "ghr_"]], [["xox"]], [["PRIVATE KEY-----"]],
    [["eyJ"]], [["Bearer"]], [["password", "passwd", "pwd"], [":", "="]],
]))


def holds_any(text: Column, needles: Sequence[str], ignore_case: bool = False, lowered: Column | None = None) -> Column:
    """Whether the text holds one of the needles; with ``ignore_case`` never a miss, and needles are lower-case.

    ``lowered`` is a column that already holds the lower-cased text, for rules that make many such tests.
    """
    seen = text if not ignore_case else F.lower(text) if lowered is None else lowered
    tests = [seen.contains(n) for n in needles]
    if ignore_case:
        tests += [text.contains(c) for c in FOLDED]
    return reduce(lambda a, b: a | b, tests)


def may_match(text: Column, pattern: str, ignore_case: bool = False, lowered: Column | None = None) -> Column:
    """False only if ``pattern`` cannot match ``text``."""
    if pattern not in GATES:
        return F.lit(True)
    ignore_case = ignore_case or pattern.startswith("(?i)")
    groups = []
    for needles in GATES[pattern]:
        if needles == [DIGITS]:
            groups.append(text.rlike(THREE_DIGITS))
        else:
            groups.append(holds_any(text, needles, ignore_case, lowered))
    return reduce(lambda a, b: a & b, groups)


def matches(text: Column, pattern: str, ignore_case: bool = False, lowered: Column | None = None) -> Column:
    """Whether ``pattern`` occurs in ``text``, tried only behind its gate."""
    found = text.rlike(java_pattern(pattern, ignore_case))
    return may_match(text, pattern, ignore_case, lowered) & found if pattern in GATES else found


def any_may_match(text: Column, patterns: Sequence[str], ignore_case: bool = False,
                  lowered: Column | None = None) -> Column:
    """False only if none of the patterns can match ``text``. Equal tests are made once."""
    tests = {}
    for p in patterns:
        key = (str(GATES.get(p, p)), ignore_case or p.startswith("(?i)"))
        if key not in tests:
            tests[key] = may_match(text, p, ignore_case, lowered) if p in GATES else matches(text, p, ignore_case)
    return reduce(lambda a, b: a | b, tests.values())


def any_match(text: Column, patterns: Sequence[str], lowered: Column | None = None) -> Column:
    """Whether one of the patterns occurs in ``text``: the gates together first, then each pattern."""
    tried = [text.rlike(java_pattern(p)) if GATES.get(p) == [[DIGITS]] else matches(text, p, lowered=lowered)
             for p in patterns]
    return any_may_match(text, patterns, lowered=lowered) & reduce(lambda a, b: a | b, tried)


def first_label(text: Column, labelled: Sequence[tuple[str, str]], ignore_case: bool = False,
                lowered: Column | None = None) -> Column:
    """Label of the first pattern (list order) found in ``text``, NULL if none."""
    return F.coalesce(*[F.when(matches(text, p, ignore_case, lowered), F.lit(label)) for label, p in labelled])


def all_labels(text: Column, labelled: Sequence[tuple[str, str]], lowered: Column | None = None) -> Column:
    """Labels of every pattern found in ``text``, list order."""
    return F.array_compact(F.array(*[F.when(matches(text, p, lowered=lowered), F.lit(label)) for label, p in labelled]))


def may_link(text: Column, lowered: Column | None = None) -> Column:
    """False only for texts without a link."""
    return holds_any(text, LINK_STARTS, True, lowered)
