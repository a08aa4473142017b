import random

import pytest
import sentencepiece

from turnwarden.llm import pieces
from turnwarden.llm.queries import tokenizer

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    rng = random.Random(5)
    letters = "aaaabcdefghijklmnopqrstuvwxyzABEST      \n\t.,'0123456789éßあ🙂▁\u0000"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [
        " " * n + "x" + " " * n for n in range(40)] + ["a" * 500, "ab" * 300, "\n\n  \n", "  ", "=====" * 9, "----- - --", "é" * 50]


def test_ids_equal_the_library(library):
    texts = odd_texts()
    assert pieces.Encoder(pieces.load(PATH)).encode(texts).to_pylist() == library.encode(texts)


def test_unigram_state_equals_brute_force():
    words = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, "▁a": -2.2, "▁ab": -4.6, "ba": -2.9, "bab": -4.4}
    v = pieces.Vocabulary([""] * 256 + list(words), [0.0] * 256 + list(words.values()), 0, "unigram")
    enc = pieces.Encoder(v)

    def best(w):
        if not w:
            return 0.0, ()
        return max((best(w[:-n])[0] + words[w[-n:]], best(w[:-n])[1] + (w[-n:],)) for n in range(1, len(w) + 1) if w[-n:] in words)
    texts = ["ab", "abab", "baba ab a", "bbab", "aaaa"]
    for text, ids in zip(texts, enc.encode(texts).to_pylist()):
        got = [v.pieces[i] for i in ids]
        want = [p for w in (pieces.MARK + text.replace(" ", pieces.MARK)).replace(pieces.MARK, " " + pieces.MARK).split() for p in best(w)[1]]
        assert abs(sum(words[p] for p in got) - sum(words[p] for p in want)) < 1e-9 and "".join(got) == "".join(want)


def test_tables(spark, tiny, none_left, library):
    shared = pieces.share(spark, PATH)
    out = pieces.encode(tiny, shared).withColumns({"back": pieces.decoder(shared)("ids"), "want": pieces.plain(pieces.F.col("text"))}).collect()
    assert len(out) == tiny.count()
    for r in out:
        assert list(r.ids) == library.encode(r.text or "") and r.n_pieces == len(r.ids) and r.back == r.want
    assert pieces.encode(none_left, shared).count() == 0
