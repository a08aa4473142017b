import re
from collections import defaultdict

from pyspark.sql import functions as F

from turnwarden.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        share = (sum(sizes.values()) - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share > 3 * sizes[s]]
        if not over:
            return {s: fixed.get(s, weight[s] * share) for s in names}
        fixed.update({s: 3 * sizes[s] for s in over})


def test_targets_taken_and_reruns(spark, tiny):
    rows = mixing.mix(tiny).collect()
    again = mixing.mix(tiny.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == tiny.count()
    texts = {r.doc_id: r.text for r in tiny.collect()}
    size, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) and 0 <= r.taken <= 3 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
    want = brute_targets(size)
    total = sum(size.values())
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
    for s in size:
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], total / 5000), (s, taken[s], want[s])


def test_highest_quotients_equal_brute_force(spark):
    weights = [("a", i, w, 1000) for i, w in enumerate([53.0, 24.0, 23.0, 1.0, 1.0, 0.2])] + [("b", i, 1.0, 3) for i in range(7)]
    parties = spark.createDataFrame(weights, "g string, k int, w double, cap long")
    seats = {"a": 17, "b": 10}
    got = {(r.g, r.k): r.quota for r in mixing.highest_quotients(
        parties, "g", "k", "w", "cap", spark.createDataFrame(list(seats.items()), "g string, _n long")).collect()}
    for g, n in seats.items():
        quotients = sorted((-w / (s + 0.5), k, s) for h, k, w, cap in weights if h == g for s in range(min(cap, n)))[:n]
        for h, k, _, _ in weights:
            if h == g:
                assert got[g, k] == sum(x[1] == k for x in quotients), (g, k)


def test_mixed_documents_hold_what_was_taken(tiny):
    ids = tiny.filter("doc_id is not null").dropDuplicates(["doc_id"])
    taken = {r.doc_id: r.taken for r in mixing.mix(ids).collect()}
    out = mixing.mixed(ids)
    assert out.columns == ids.columns
    got = defaultdict(int)
    texts = {r.doc_id: r.text for r in ids.collect()}
    for r in out.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        got[r.doc_id] += n
        assert not n or (r.text == texts[r.doc_id] or len(r.text) < len(texts[r.doc_id]))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v}


def test_mixed_rows_with_null_and_repeated_ids_hold_what_was_taken(spark):
    def text(name, n):
        return " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, text("a", 300), "s0"), (None, text("b", 200), "s1"), (7, text("c", 50), "s1"), (7, text("d", 400), "s1"), (7, text("d", 400), "s1"),
            (8, text("e", 120), "s2"), (None, None, "s2"), (9, text("f", 90), "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    taken, got = defaultdict(int), defaultdict(int)
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source, r.size] += r.taken
    sizes = {t.split()[0][0]: (i, s, len(t.split())) for i, t, s in rows if t}
    out = mixing.mixed(docs).collect()
    for r in out:
        words = (r.text or "").split()
        if words:
            got[sizes[words[0][0]]] += len(words)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v}
    assert sum(r.text is None for r in out) == 1


def test_empty(none_left):
    assert mixing.mix(none_left).count() == 0
    assert mixing.mixed(none_left.select("doc_id", "text", "source", F.lit(1).alias("n_chars"))).count() == 0
