"""License scans: ordered signature rules over whole texts.

A rule is a pattern over the normalised words of a text, the keywords without which it cannot match, a label, a priority and
a confidence. A first gate, evaluated in the JVM, sends only texts with a telling keyword to Python; there one automaton finds
all keywords in one pass, and a pattern runs only where all of its keywords stand. A detection is suppressed when its words
lie inside those of another one of higher priority, or of equal priority and greater length (then: the earlier rule).
Detections of the base phrases always stay.

Rows are independent and nothing is shuffled. Defined results: a null text counts as empty; texts without words have no
detections; repeated rows and null ids are scanned like all others; other columns pass through, and those that carry a name
the operator returns are replaced.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DETECTION = "array<struct<label:string,rule:string,first_word:long,n_words:int,priority:int,score:double,base:boolean>>"

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: License families as label, the words of the identifier, and a pattern for the name in running text.
FAMILIES = (
    ("mit", "mit", r"(?:mit|expat)"),
    ("mit-0", "mit 0", r"mit no attribution"),
    ("apache-1.1", "apache 1 1", r"apache(?: software)? 1 1"),
    ("apache-2", "apache 2 0", r"apache(?: 2(?: 0)?)?"),
    ("bsd-2-clause", "bsd 2 clause", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)"),
    ("bsd-3-clause", "bsd 3 clause", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)"),
    ("bsd-4-clause", "bsd 4 clause", r"(?:bsd 4 clause|4 clause bsd|original bsd)"),
    ("0bsd", "0bsd", r"(?:0bsd|zero clause bsd)"),
    ("gpl-1", "gpl 1 0", r"(?:gnu )?(?:gpl|general public) v?1(?: 0)?"),
    ("gpl-2", "gpl 2 0", r"(?:gnu )?(?:gpl|general public) v?2(?: 0)?"),
    ("gpl-3", "gpl 3 0", r"(?:gnu )?(?:gpl|general public) v?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?(?:gpl|general public)"),
    ("lgpl-2", "lgpl 2 0", r"(?:gnu )?(?:lgpl|library general public) v?2(?: 0)?"),
    ("lgpl-2.1", "lgpl 2 1", r"(?:gnu )?(?:lgpl|lesser general public) v?2 1"),
    ("lgpl-3", "lgpl 3 0", r"(?:gnu )?(?:lgpl|lesser general public) v?3(?: 0)?"),
    ("lgpl", "lgpl", r"(?:gnu )?(?:lgpl|lesser general public)"),
    ("agpl-3", "agpl 3 0", r"(?:gnu )?(?:agpl|affero general public)(?: v?3(?: 0)?)?"),
    ("fdl-1.2", "gfdl 1 2", r"(?:gnu )?(?:gfdl|free documentation) v?1 2"),
    ("fdl-1.3", "gfdl 1 3", r"(?:gnu )?(?:gfdl|free documentation)(?: v?1 3)?"),
    ("mpl-1.1", "mpl 1 1", r"(?:mpl|mozilla public) v?1 1"),
    ("mpl-2", "mpl 2 0", r"(?:mpl|mozilla public)(?: v?2(?: 0)?)?"),
    ("epl-1", "epl 1 0", r"(?:epl|eclipse public) v?1(?: 0)?"),
    ("epl-2", "epl 2 0", r"(?:epl|eclipse public)(?: v?2(?: 0)?)?"),
    ("eupl-1.2", "eupl 1 2", r"(?:eupl|european union public)(?: v?1 2)?"),
    ("cddl-1", "cddl 1 0", r"(?:cddl|common development and distribution)(?: v?1(?: 0)?)?"),
    ("cpl-1", "cpl 1 0", r"(?:cpl|common public)(?: v?1(?: 0)?)?"),
    ("ms-pl", "ms pl", r"(?:ms pl|microsoft public)"),
    ("ms-rl", "ms rl", r"(?:ms rl|microsoft reciprocal)"),
    ("artistic-1", "artistic 1 0", r"artistic 1(?: 0)?"),
    ("artistic-2", "artistic 2 0", r"artistic(?: 2(?: 0)?)?"),
    ("bsl-1", "bsl 1 0", r"boost(?: software)?"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"(?:zlib|libpng)"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"(?:wtfpl|do what the fuck you want to public)"),
    ("python-2", "python 2 0", r"(?:python software foundation|psf)"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("ofl-1.1", "ofl 1 1", r"(?:ofl|sil open font)(?: v?1 1)?"),
    ("odbl-1", "odbl 1 0", r"(?:odbl|open database)(?: v?1(?: 0)?)?"),
    ("cc0-1", "cc0 1 0", r"(?:cc0|creative commons zero)(?: 1(?: 0)?)?"),
    ("cc-by", "cc by", r"(?:cc by|creative commons attribution)(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by nd", r"(?:cc by nd|creative commons attribution no ?derivatives)(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives)(?: [1-4] [05])?"),
)

#: The ways in which texts name a license. {id} the identifier's words, {name} the pattern of its name.
TEMPLATES = (
    ("spdx", r"spdx license identifier {id}(?: only| or later)?", ("spdx",), 100, 1.0),
    ("url", r"(?:opensource|spdx|choosealicense) (?:org|com) licenses? {id}", ("licen",), 90, 0.95),
    ("licensed", r"licen[cs]ed (?:to you )?(?:only )?under (?:the )?(?:terms of )?(?:the )?{name}(?: (?:public )?licen[cs]e)?",
     ("licen", "under"), 80, 0.9),
    ("grant", r"(?:released|distributed|available|provided|published|covered|shared) (?:to you )?(?:only )?"
              r"under (?:the )?(?:terms of )?(?:the )?{name} (?:public )?licen[cs]e", ("licen", "under"), 80, 0.9),
    ("under", r"under (?:the )?(?:terms of )?(?:the )?{name} (?:public )?licen[cs]e", ("under", "licen"), 70, 0.8),
    ("version", r"{name} (?:public )?licen[cs]e v(?:ersion)? ?[0-9]+(?: [0-9]+)?", ("licen",), 60, 0.8),
    ("header", r"licen[cs]e (?:is )?(?:the )?{name}", ("licen",), 50, 0.6),
    ("name", r"{name} (?:public )?licen[cs]e", ("licen",), 40, 0.6),
)

#: Notices that name no family.
NOTICES = (
    ("public-domain", r"(?:dedicated to|released into|in) the public domain", ("domain",), 60, 0.7),
    ("proprietary", r"all rights reserved", ("reserved",), 30, 0.5),
    ("proprietary", r"proprietary and confidential", ("proprietary",), 40, 0.6),
    ("no-warranty", r"provided as is without warranty of any kind", ("warranty",), 20, 0.3),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", ("hereby",), 75, 0.9),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", ("permission",), 75, 0.8),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", ("redistribution",), 65, 0.8),
    ("gpl", r"free software you can redistribute it and or modify it", ("redistribute",), 65, 0.7),
)

#: Every rule needs one of these in the text, whatever its letter case. Matched by the JVM before a text goes to Python.
GATE = (r"(?i)licen|spdx|(?<![0-9a-z])cc|gpl|domain|reserved|proprietary|warranty|hereby|permission|redistribut")


class Rule(NamedTuple):
    name: str
    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    score: float
    base: bool = False


def first_words(name: str) -> set[str]:
    """The words of which one must begin a match of ``name``: the first word of each alternative, without optional groups."""
    while name != (name := re.sub(r"\(\?:[^()]*\)\?", "", name)):
        pass
    choices = name[3:name.index(")")].split("|") if name.startswith("(?:") else [name]
    return {c.split()[0] for c in choices}


def rules() -> list[Rule]:
    """The base phrases, every template filled for every family, and the notices; several hundred rules in all."""
    out = [Rule(f"base:{label}", label, phrase, (max(phrase.split(), key=len),), 110, 1.0, True) for phrase, label in BASE.items()]
    for label, words, name in FAMILIES:
        own = "|".join(sorted(first_words(name)))
        for kind, template, keywords, priority, score in TEMPLATES:
            pattern = template.format(id=words, name=name)
            extra = words.split()[0] if "{id}" in template else own
            out.append(Rule(f"{kind}:{label}", label, pattern, (*keywords, extra), priority, score))
    return out + [Rule(f"notice:{label}:{i}", label, pattern, keywords, priority, score)
                  for i, (label, pattern, keywords, priority, score) in enumerate(NOTICES)]


class Scanner:
    """Rules made ready: one automaton over all keywords, and a compiled pattern per rule. Built once per Python worker."""

    def __init__(self, table: list[Rule]):
        import ahocorasick
        self.table = [(r, re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])"), [set(k.split("|")) for k in r.keywords]) for r in table]
        self.keywords = ahocorasick.Automaton()
        for word in {k for _, _, sets in self.table for s in sets for k in s}:
            self.keywords.add_word(word, word)
        self.keywords.make_automaton()

    def scan(self, text: str) -> list[tuple]:
        words = WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
        joined = " ".join(words)
        present = {word for _, word in self.keywords.iter(joined)}
        found = [(m.start(), m.end(), i) for i, (_, pattern, sets) in enumerate(self.table)
                 if all(s & present for s in sets) for m in pattern.finditer(joined)]
        if not found:
            return []
        starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        kept = []
        for start, end, i in unsuppressed(found, [(r.priority, r.base) for r, _, _ in self.table]):
            rule = self.table[i][0]
            first = int(np.searchsorted(starts, start))
            kept.append((rule.label, rule.name, first, int(np.searchsorted(starts, end)) - first, rule.priority, rule.score, rule.base))
        return kept


def unsuppressed(found: list[tuple[int, int, int]], rank: list[tuple[int, bool]]) -> list[tuple[int, int, int]]:
    """``(start, end, rule)`` without those inside a stronger one. One pass in order of start: whatever contains an interval
    comes before it, so the furthest end seen per priority decides."""
    furthest: dict[int, int] = {}
    out = []
    for start, end, i in sorted(found, key=lambda x: (x[0], -x[1], -rank[x[2]][0], x[2])):
        priority, base = rank[i]
        if base or not any(p >= priority and e >= end for p, e in furthest.items()):
            out.append((start, end, i))
        furthest[priority] = max(furthest.get(priority, -1), end)
    return out


_SCANNER: list[Scanner] = []


def _scan(texts: pd.Series) -> pd.Series:
    if not _SCANNER:
        _SCANNER.append(Scanner(rules()))
    return pd.Series([[] if t is None else _SCANNER[0].scan(t) for t in texts], dtype=object)


def detections(text: Column) -> Column:
    """What the rules find in ``text``, in order of the first word; empty where the gate does not open."""
    return F.coalesce(F.pandas_udf(_scan, DETECTION)(F.when(text.rlike(GATE), text)), F.array().cast(DETECTION))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``detections``."""
    full = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"n_words": F.size(F.array_remove(F.split(full, NOT_WORD), "")).cast("long"),
                             "detections": detections(F.col(text))})


def digest(scanned: DataFrame) -> DataFrame:
    """``scanned`` with counts, ends and labels in place of the detections; ``score`` is the strongest detection's."""
    base = F.filter("detections", lambda d: d["base"])
    firsts = F.transform(base, lambda d: d["first_word"])

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")

    return scanned.withColumns({
        "n_base": F.size(base).cast("long"), "first_word": F.array_min(firsts), "last_word": F.array_max(firsts),
        "base_labels": labels(base), "labels": labels(F.col("detections")),
        "score": F.coalesce(F.array_max(F.transform("detections", lambda d: d["score"])), F.lit(0.0)),
        "n_detections": F.size("detections").cast("long")}).drop("detections")
