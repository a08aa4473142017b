"""Regex flavour: patterns are written once and must mean the same to Spark as to the rule's author.

The patterns use Unicode ``\\d``, ``\\w`` and ``\\s`` and Unicode case folding. Java needs the ``U`` flag for that,
and three classes spelled out where Java's Unicode definition is wider or narrower (marks and joiners are not word
characters, the four information separators are white space).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f"


def java_pattern(pattern: str, ignore_case: bool = False) -> str:
    """``pattern`` for Spark's regex functions, with Unicode classes."""
    if pattern.startswith("(?i)"):
        pattern, ignore_case = pattern[4:], True
    out, in_class, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            e = pattern[i + 1]
            if e == "s":
                out.append(SPACE if in_class else f"[{SPACE}]")
            elif e == "S":
                out.append(f"[^{SPACE}]")
            elif e == "w":
                out.append(WORD if in_class else f"[{WORD}]")
            elif e == "d":
                out.append(r"\p{Nd}")
            else:
                out.append(c + e)
            i += 2
            continue
        if c == "[" and not in_class:
            in_class = True
        elif c == "]" and in_class:
            in_class = False
        out.append(c)
        i += 1
    return ("(?iU)" if ignore_case else "(?U)") + "".join(out)


def any_of(patterns: Sequence[str], ignore_case: bool = False) -> str:
    """One alternation that matches iff one of the patterns does: a single scan for the common no-hit row."""
    parts = [java_pattern(p, ignore_case) for p in patterns]
    return "|".join(f"(?:{p})" for p in parts)


def literal(term: str) -> str:
    """``term`` as a pattern that matches only itself."""
    return re.sub(r"([\\^$.|?*+()\[\]{}\-&~#])", r"\\\1", term)


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))
