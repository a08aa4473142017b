import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnwarden.llm import minhash, text
from turnwarden.sources import shared


def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set())
    return out


def brute(rows):
    """Component by (position of the) row; ids are unique here."""
    sets = brute_sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b, key=lambda k: rows[k][0])] = min(a, b, key=lambda k: rows[k][0])
    return {rows[i][0]: (len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


def check(spark, rows):
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id), r
    return got


def test_groups_equal_brute_force(spark, tiny):
    rows = [(r.doc_id, r.text) for r in tiny.collect() if r.doc_id is not None and r.doc_id != 9005]
    assert any(not r.kept for r in check(spark, rows))


@pytest.mark.parametrize("pivots", [0, 1])
def test_chains_and_large_groups(spark, monkeypatch, pivots):
    """Chains of edits reach far below the similarity; components must not depend on the pivot."""
    monkeypatch.setattr(minhash, "PIVOTS", pivots)
    rng = random.Random(11)
    rows, word = [], lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    for start in range(3):
        w = [word() for _ in range(60)]
        for _ in range(40):
            w = list(w)
            w[rng.randrange(60)] = word()
            rows.append((len(rows) * 7 % 1000 + 1000 * start, " ".join(w)))
    rng.shuffle(rows)
    check(spark, rows)


def test_estimate_is_unbiased_with_less_spread():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 60, dtype=np.uint64)
        sig = minhash.signatures(np.concatenate([np.sort(pool[:45]), np.sort(pool[15:])]), np.array([45, 45]))
        errors.append((sig[0] == sig[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < np.sqrt(0.25 / minhash.SLOTS)


def test_odd_rows(spark, tiny, none_left):
    got = minhash.groups(tiny).collect()
    assert len(got) == tiny.count()
    by = {r.doc_id: r for r in got}
    assert by[9001].n_shingles == by[9002].n_shingles == by[9003].n_shingles == 0 and by[9001].kept and by[9003].kept
    assert by[9004].n_shingles == 1 and [r.component_id for r in got if r.doc_id is None] == [None]
    assert minhash.groups(none_left).count() == 0
    out = minhash.deduplicated(tiny)
    assert out.columns == tiny.columns and out.count() == sum(r.kept for r in got)


def test_rows_of_null_and_repeated_ids_are_documents_of_their_own(spark):
    rng = random.Random(4)

    def prose():
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    a, b, c, d, e, f = (prose() for _ in range(6))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c + " end"), (2, d), (5, d), (5, e), (6, f), (6, f), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in minhash.deduplicated(docs).collect()), key=str)
    c_kept = [r for r in got if r[1] in (c, c + " end")]
    assert len(c_kept) == 1 and c_kept[0][0] is None
    assert [r for r in got if r not in c_kept] == sorted([(1, a), (None, b), (2, d), (5, e), (6, f), (None, None), (None, None)], key=str)
    marks = minhash.groups(docs).collect()
    assert len(marks) == len(rows) and sum(r.kept for r in marks) == len(got)
    assert sorted(str(r.component_id) for r in marks if r.doc_id is None) == ["1", "None", "None", "None", "None", "None"]


def joined_on(df, column):
    """Names and types of the columns on both sides of the joins on a column."""
    todo, out = [df._jdf.queryExecution().analyzed()], []
    while todo:
        node = todo.pop()
        children = [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "Join" and f"{column}#" in node.condition().toString():
            outputs = [c.output() for c in children]
            out += [[(o.apply(k).name(), o.apply(k).dataType().typeName()) for k in range(o.size())] for o in outputs]
        todo += children
    return out


def test_elements_meet_without_the_lists_they_stand_in(spark):
    """A row per element that holds the whole list shuffles the square of its length."""
    rng = random.Random(6)
    base = rng.sample(range(10**6), 120)
    found = [sorted(set(base) - set(rng.sample(base, k)) | set(rng.sample(range(10**6), k))) for k in (0, 3, 5, 9, 14, 30, 60)]
    found += [sorted(rng.sample(range(10**6), 100)) for _ in range(3)]
    left = spark.createDataFrame([((i, i, -i, len(s)), (i, i, -i, len(s))) for i, s in enumerate(found)], "a {0}, label {0}".format(
        "struct<o: bigint, d1: bigint, d2: bigint, n: bigint>"))
    sets = spark.createDataFrame([(i, -i, s) for i, s in enumerate(found)], "d1 long, d2 long, list array<long>")
    pairs = minhash.unconnected(left, sets, 80)
    got = [tuple(sorted((r.a.d1, r.b.d1))) for r in pairs.collect()]
    alike = {(i, j) for j in range(len(found)) for i in range(j) if len({*found[i]} & {*found[j]}) >= 0.8 * len({*found[i]} | {*found[j]})}
    assert len(alike) == 5 and alike <= set(got) and len(got) == len(set(got))
    assert [{kind for _, kind in side} & {"array"} for side in joined_on(pairs, "token")] == [set(), set()]


def test_keys_meet_without_their_classes(spark, tiny, monkeypatch):
    """Entries of keys that stand alone are shuffled as key and number only."""
    made = {}
    monkeypatch.setattr(minhash, "released", lambda df, purpose, f=minhash.released: made.setdefault(purpose, df) and f(df, purpose))
    minhash.groups(tiny).count()
    assert {name for name, _ in joined_on(made["minhash-buckets"], "key")[0]} == {"key", "no"}


@pytest.fixture
def folders(monkeypatch):
    """The folders that are made below the shared one, by purpose, and whether they are still there."""
    made = []
    monkeypatch.setattr(shared, "new_folder", lambda spark, purpose, f=shared.new_folder: made.append(f(spark, purpose)) or made[-1])
    return lambda: {(os.path.basename(p).rsplit("-", 1)[0], os.path.exists(p.removeprefix("file:"))) for p in made}


def test_rows_that_stay_are_not_joined_and_tables_go(spark, tiny, monkeypatch, folders):
    seen = []
    monkeypatch.setattr(minhash, "parted", lambda *a, f=minhash.parted: seen.append(f(*a)) or seen[-1])
    docs = tiny.select("doc_id", "text").unionByName(tiny.select((tiny.doc_id + 20000).alias("doc_id"), "text").limit(20))
    out = minhash.deduplicated(docs)
    some, others = seen[0]
    assert 0 < some.count() < others.count() and some.count() + others.count() == docs.count()
    left = {name for name, there in folders() if there}
    assert "minhash-gone" in left and not left & {"minhash-sketch", "minhash-classes", "minhash-keys", "minhash-buckets", "minhash-pairs"}
    assert out.count() == sum(r.kept for r in minhash.groups(docs).collect())


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_parted_rows_are_all_there(spark, monkeypatch, bits):
    monkeypatch.setattr(text, "BITS", bits)
    rows = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), "id")
    some, others = ({r.id for r in df.collect()} for df in text.parted(rows, rows.filter("k % 7 = 0 or k is null").select("k"), "k"))
    assert not some & others and some | others == set(range(1000)) and {i for i in range(1000) if i % 7 == 0 or i % 10 == 0} <= some
    assert len(others) > 700 if bits > 64 else not others
