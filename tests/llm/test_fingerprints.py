import hashlib
import re
from collections import Counter

from turnwarden.llm import fingerprints


def jaccard(a, b):
    x, y = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
    top = sum((x | y).values())
    return sum((x & y).values()) / top if top else 1.0


def test_edits_order_and_likeness(tiny):
    docs = tiny.filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    assert set(got) == set(ids)
    off, same = [], {}
    for i, d in enumerate(ids):
        text, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == (8 * fingerprints.SAMPLES if text.strip(" \t\n\v\f\r") else 0)
        off += [abs(r.near_edited - jaccard(text, edited)), abs(r.near_next - jaccard(text, after))]
        assert r.near_next == 1.0 or text != after
    assert sum(off) / len(off) < 0.05 and max(off) < 0.35


def test_odd_rows_and_no_python(tiny, none_left):
    out = fingerprints.fingerprints(tiny)
    assert out.count() == tiny.count()
    assert "Python" not in out._jdf.queryExecution().toString()
    assert fingerprints.fingerprints(none_left).count() == 0
    one = fingerprints.fingerprints(tiny.filter("doc_id = 9006")).collect()
    assert [r.near_next for r in one] == [1.0]
