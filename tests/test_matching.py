"""Terms looked up where the text is, against the join that larger tables take."""

import random

import pytest
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import lookups as look
from turnwarden.operators import matching
from turnwarden.operators import output_rules as out

WORDS = ["ban", "bank", "über", "a-b", "c++", "x", "ban bank", "bank ban", "straße", ".net", "Ünï Köln", "σας", "ς", "İx", "istanbul", "ſs", "kelvin",
         "_a", "😀", "x😀", "é", "ελλας", "µm", "μm", "a term of more than four and twenty letters", "a term of"]
MORE = [*WORDS, "banks", "xx", "W7", "BAN", "-", "\n", "urban", "a-bc", "c++,", "ISTANBUL", "ıstanbul", "SS", "Kelvin", "ΕΛΛΑΣ", "ΣΑΣ", "ÉB", "Ⓐ",
        "1a", "‍", "μM", "ΜM", "BANK"]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([" ", "", "-"]).join(rng.choice(MORE) for _ in range(rng.randrange(14)))) for i in range(300)]
    return spark.createDataFrame([*rows, (900, None), (901, ""), (902, "ban " * 5000)], "id long, text string").cache()


def listed(spark, terms):
    return spark.createDataFrame([*enumerate(terms), (999, None), (5, "BAN"), (6, "ban"), (5, "ban"), (7, "")], "ord int, term string")


def both(monkeypatch, run):
    found = []
    for most in (matching.MOST, -1):
        monkeypatch.setattr(matching, "MOST", most)
        found.append(sorted(map(tuple, run().collect())))
    monkeypatch.undo()
    return found


def test_names_are_scrubbed_the_same_without_a_join(spark, texts, monkeypatch):
    for words in ([], WORDS):
        here, joined = both(monkeypatch, lambda: out.brand_scrub_table(texts.filter("text is not null"), listed(spark, words), "<$1>").select(
            "id", "text", F.to_json("decisions")))
        assert here == joined and any("<$1>" in r[1] for r in here)
    assert here[-1][1] == "<$1> " * 5000


def test_topics_are_found_the_same_without_a_join(spark, texts, monkeypatch):
    kb = listed(spark, WORDS).select("ord", F.col("term").alias("topic"), F.concat(F.lit("e"), "ord").alias("text"))
    for entries in (kb.filter("topic <> ''"), kb):
        here, joined = both(monkeypatch, lambda: look.kb_match(texts, entries).select("id", "kb_result"))
        assert here == joined and dict(here)[900] == fixed.KB_MISS


def test_tables_that_tasks_hold_shuffle_nothing(spark, texts):
    terms = listed(spark, WORDS)
    for done in (out.brand_scrub_table(texts, terms), look.kb_match(texts, terms.withColumnRenamed("term", "topic").withColumn("text", F.lit("e")))):
        assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


def test_few_entries_at_a_time_give_the_same(spark, texts, monkeypatch):
    """Lists are written some entries at a time, texts are taken some bytes at a time."""
    import pyarrow as pa
    rows = [(t, f"[{t}] {i}") for i in range(7) for t in ("er", "r", "the river bank")]
    table = pa.table({"term": [t for t, _ in rows], "shown": [s for _, s in rows]})
    found = matching.Listed(table, False, False)
    given = pa.array(["river", None, "", "the river bank or", "the river ban", "x"])
    parts = matching.Bytes(given)

    def joined():
        text, _, _, code = found.rest.found(parts)
        return found.joined(text, code, len(given), "|").to_pylist()

    whole = joined()
    monkeypatch.setattr(matching, "ENTRIES", 1)
    assert joined() == whole
    want = [[s for t, s in rows if g and t in g] for g in given.to_pylist()]
    assert whole == ["|".join(w) if w else None for w in want]
