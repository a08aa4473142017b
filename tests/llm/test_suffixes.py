import hashlib
import os
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from turnwarden.llm import suffixes
from turnwarden.sources import shared


def brute(texts):
    """(n_bytes, n_removed, n_spans, sha256) per text, from all strings of all texts."""
    data = [(t or "").encode() for t in texts]
    n = suffixes.SPAN
    seen = Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - n + 1):
            if seen[d[i:i + n]] > 1:
                gone[i:i + n] = 1
        gone = gone[:len(d)]
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(df).select("_doc.doc_id", "*").collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i] == want[i], (i, got[i], want[i])
    return want


def test_random_repeats_equal_brute_force(spark):
    rng = random.Random(4)

    def fresh(n):
        return "".join(rng.choice("abcdé fghij") for _ in range(n))
    shared = [fresh(rng.randint(190, 700)) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(fresh(rng.randint(0, 260)))
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts.append(s[a:rng.randint(a, len(s))])
        texts.append("".join(parts))
    # Near copies with single changes, periodic texts, exact copies, and strings just below and at the length.
    base = fresh(1500)
    for _ in range(15):
        t = list(base)
        for _ in range(rng.randint(1, 6)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [base, base, "a" * 199, "a" * 200, "a" * 450, "ab" * 300, "abc" * 300, "x" + "abc" * 150, None, "", shared[0][:199], shared[0][:200], "🙂" * 90]
    want = check(spark, texts)
    assert 10 < sum(w[1] > 0 for w in want) < len(want)


def test_segments_do_not_matter(spark, monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    whole = [(p, c, h) for x in suffixes.blocks((text * 2).encode()) for p, c, h in zip(*map(np.ndarray.tolist, x))]
    assert sum(p >> 8 & 255 for p, _, _ in whole) == 6000 - suffixes.SPAN + 1
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    cut = [p for x in suffixes.blocks((text * 2).encode()) for p in x[0].tolist()]
    assert {(p >> 16) + k: (p >> 16) + (p & 255) for p in cut for k in range(p >> 8 & 255)} == {
        (p >> 16) + k: (p >> 16) + (p & 255) for p, _, _ in whole for k in range(p >> 8 & 255)}


def test_tables(spark, tiny, none_left):
    rows = tiny.select("doc_id", "text").collect()
    got = sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffixes.removed(tiny).select("_doc.doc_id", "*").collect())
    assert got == sorted(str((r.doc_id, *w)) for r, w in zip(rows, brute([r.text for r in rows])))
    assert suffixes.removed(none_left).count() == 0
    out = suffixes.deduplicated(tiny.withColumn("n_chars", F.lit(1)))
    assert out.columns == tiny.columns and out.filter("n_chars <> length(text)").count() == 0


def test_cut_characters(spark):
    """Runs that begin or end inside a character leave no broken text."""
    shared = "".join(random.Random(2).choice("abcdefgh") for _ in range(300))
    texts = ["x é" + shared + "à y", "x ũ" + shared + "ā y", "only \ufffd here"]  # the letters share their last and first bytes
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.length("text"))
    rows = {r.doc_id: r for r in suffixes.deduplicated(df).collect()}
    assert rows[2].text == texts[2]
    assert all(r.n_chars == len(r.text) and "\ufffd" not in r.text and "\x00" not in r.text for i, r in rows.items() if i < 2)
    assert rows[0].text.startswith("x") and rows[0].text.endswith("y") and shared[:50] not in rows[0].text


def test_texts_without_repeats_are_not_joined_and_tables_go(spark, monkeypatch):
    rng, made, seen = random.Random(8), [], []
    monkeypatch.setattr(shared, "new_folder", lambda spark, purpose, f=shared.new_folder: made.append(f(spark, purpose)) or made[-1])
    monkeypatch.setattr(suffixes, "parted", lambda *a, f=suffixes.parted: (out := f(*a), seen.append([x.count() for x in out]))[0])
    texts = ["".join(rng.choice("abcdef ") for _ in range(700)) for _ in range(30)]
    check(spark, [*texts, texts[3], texts[5][:300] + "x" * 20, None, None])
    assert len(seen) == 3 and all(sum(n) == 34 and n[0] < 8 for n in seen), seen
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in made if os.path.exists(p.removeprefix("file:"))}
    assert left == {"suffix-runs"}, left
