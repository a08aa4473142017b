import re

from turnwarden.llm import licenses


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w))
          if w[i:i + len(phrase.split())] == phrase.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({b for _, b in at}))


def test_base_columns_equal_brute_force(spark, tiny):
    more = spark.createDataFrame([(9101, "X under the-MIT\nLicense; under the mit license 2 cc-by-nc (CC BY NC) Apache License, Version 2.0!", "en", "s", 1),
                                  (9102, "éunder the mit license under the mit licenseé İ", "en", "s", 1)], tiny.drop("n_words", "kept", "size").schema)
    rows = licenses.digest(licenses.scan(tiny.unionByName(more, allowMissingColumns=True))).collect()
    assert len(rows) == tiny.count() + 2
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(r.text), r.doc_id
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any(r.n_base for r in rows)


def test_every_rule_opens_gate_and_prefilter_loses_nothing():
    table = licenses.rules()
    assert len(table) > 300 and len({r.name for r in table}) == len(table)
    texts = ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-3.0-or-later",
             "released under the GNU General Public License version 2", "license: BSD 3-Clause", "all rights reserved",
             "https://opensource.org/licenses/MIT", "the Mozilla Public License v2.0", "CC BY-SA 4.0 license", "nothing here"]
    scanner = licenses.Scanner(table)
    for text in texts:
        joined = " ".join(licenses.WORD.findall(text.lower()))
        plain = [(m.start(), m.end(), i) for i, r in enumerate(table) for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", joined)]
        want = {table[i].name for _, _, i in licenses.unsuppressed(plain, [(r.priority, r.base) for r in table])}
        assert {d[1] for d in scanner.scan(text)} == want
        assert not plain or re.search(licenses.GATE, text)


def test_containment_by_priority():
    rank = [(50, False), (70, False), (70, False), (10, True)]
    got = licenses.unsuppressed([(0, 10, 0), (2, 8, 1), (2, 8, 2), (3, 5, 0), (20, 30, 2), (22, 28, 1), (22, 25, 3)], rank)
    assert got == [(0, 10, 0), (2, 8, 1), (20, 30, 2), (22, 25, 3)]


def test_empty_table(none_left):
    assert licenses.digest(licenses.scan(none_left)).count() == 0
