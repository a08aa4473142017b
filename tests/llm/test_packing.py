import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from turnwarden.llm import packing
from turnwarden.llm.queries import tokenizer

RANKS = packing.load(tokenizer("byte_bpe_50k.tiktoken"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_best_fit_equals_brute_force(lengths):
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            # Among rows of equal room the choice changes no room sizes.
            room[room.index(min(fits))] -= lengths[i]
        else:
            room.append(20 - lengths[i])
    rows = packing.best_fit(lengths, 20)
    assert sorted(20 - sum(lengths[i] for i in r) for r in rows) == sorted(room)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))


def test_units_give_the_ids_of_the_whole_text():
    tokens = packing.Tokens(RANKS)
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice("ab'st  \n\t\r.,;1é\x1c\x85 🙂_") for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(tokens.encode(text), "<u2").tolist() == tokens.encoding.encode_ordinary(text)


def test_rows_give_the_texts_back(spark, tiny, none_left):
    shared = packing.share(spark, tokenizer("byte_bpe_50k.tiktoken"))
    docs = tiny.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.packed(docs, shared, length=256, group=5000).collect()
    parts = {}
    for r in rows:
        ids = packing.matrix(r.ids, 256)[0]
        assert len(r.ids) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256 and (ids[r.n_tokens:] == packing.PAD).all()
        resets = np.flatnonzero(np.unpackbits(np.frombuffer(r.resets, np.uint8)))
        assert resets.tolist() == sorted({a for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]) if a < b})
        assert all(packing.positions(r.cu_seqlens, 256)[a] == 0 for a in resets)
        for k, (d, c) in enumerate(zip(r.doc_ids, r.chunks)):
            parts[d, c] = ids[r.cu_seqlens[k]:r.cu_seqlens[k + 1]].tolist()
    tokens = packing.Tokens(RANKS)
    for r in docs.collect():
        ids = [i for c in sorted(c for d, c in parts if d == r.doc_id) for i in parts[r.doc_id, c]]
        assert tokens.encoding.decode(ids) == (r.text or "")
    assert packing.packed(tiny, shared).count() > 0 and packing.packed(none_left, shared).count() == 0
