import re

from turnwarden.llm import quality
from turnwarden.llm.queries import ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = {}
    for i, g in enumerate(grams):
        seen.setdefault(g, []).append(i)
    covered = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(tiny):
    rows = quality.apply_rules(tiny).collect()
    assert len(rows) == tiny.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.doc_id
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_keeps_input_columns_and_empty_tables(tiny, none_left):
    good = quality.keep_good(tiny)
    assert good.columns == tiny.columns and 0 < good.count() < tiny.count()
    assert quality.keep_good(none_left).count() == 0


def test_no_shuffle_and_no_python(tiny):
    plan = quality.apply_rules(tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("RangeExchange", "") and "Python" not in plan


def test_sql_is_given():
    assert "op1_quality_rules" in ORACLE
