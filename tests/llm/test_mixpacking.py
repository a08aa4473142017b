import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from turnwarden.llm import mixpacking
from turnwarden.llm.queries import tokenizer
from turnwarden.llm.units import Texts, byte_level, checked

PATH = tokenizer("byte_bpe_50k.json")


def library_ids(texts):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(PATH)
    model.encode_special_tokens = True
    return [e.ids + [0] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_units_give_the_ids_of_whole_texts(tiny):
    import random

    import pyarrow as pa
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab's'll  \n\n\t\r.,;1é\x1c\x85\xa0 　🙂_À中\x7f") for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    texts += [r.text or "" for r in tiny.select("text").collect()] + ["say <|endoftext|> twice <|endoftext|>"]
    ids, borders = byte_level(checked(PATH)).encode(Texts(pa.array(texts)))
    assert [ids[a:b].tolist() + [0] for a, b in zip(borders, borders[1:])] == library_ids(texts)


def check_whole(docs, sequences, length):
    """Every id of every document lies in one piece, and every sequence is full."""
    want = defaultdict(list)
    for r, ids in zip(docs, library_ids([r.text for r in docs])):
        want[r.doc_id].append(ids)
    found = defaultdict(list)
    for s in sequences:
        ids = np.frombuffer(s.ids, "<u2").astype("<u4")
        assert len(ids) == s.n_tokens == sum(s.lengths) and (s.n_tokens == length or s.n_tokens & (s.n_tokens - 1) == 0)
        assert s.offsets == [0, *np.cumsum(s.lengths)[:-1].tolist()]
        for d, start, n, at, crc, total in zip(s.doc_ids, s.starts, s.lengths, s.offsets, s.crcs, s.doc_tokens):
            piece = ids[at:at + n]
            assert zlib.crc32(piece.tobytes()) == crc
            found[d].append((total, start, tuple(piece.tolist())))
    assert found.keys() == want.keys()
    for d, texts in want.items():
        if len(texts) == 1:
            parts = sorted(found[d], key=lambda x: x[1])
            assert [i for _, _, p in parts for i in p] == texts[0] and all(x[0] == len(texts[0]) for x in parts)
            assert [x[1] for x in parts] == [0, *np.cumsum([len(x[2]) for x in parts])[:-1].tolist()]
        else:
            assert Counter(i for _, _, p in found[d] for i in p) == Counter(i for t in texts for i in t)


def test_every_id_lies_in_one_piece(spark, tiny, none_left):
    shared = mixpacking.share(spark, PATH)
    for length, part in ((1024, 1 << 20), (256, 4096)):
        check_whole(tiny.collect(), mixpacking.packed(tiny, shared, length=length, part=part).collect(), length)
    assert mixpacking.packed(none_left, shared).count() == 0


def test_windows_hold_the_proportions(spark, tiny):
    shared = mixpacking.share(spark, PATH)
    docs = tiny.filter("doc_id < 9000").withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    found = mixpacking.packed(docs, shared, part=1 << 15)
    rows = mixpacking.pieces(found).groupBy("sequence_id").pivot("source").sum("length").na.fill(0).orderBy("sequence_id").collect()
    table = np.array([r[1:] for r in rows], float)
    share = table.sum(0) / table.sum()
    # The running mix never strays by more than a few grains from its target, whatever the number of windows.
    strays = np.abs(np.cumsum(table, 0) - np.cumsum(table.sum(1))[:, None] * share).max()
    assert strays < 4 * mixpacking.GRAIN
    assert np.abs(table[:, 0] / table.sum(1) - share[0])[table.sum(1) == 1024].max() < 0.35


def test_weights_hold_until_a_source_is_dry(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 3], "word " * (200 if i % 3 else 100)) for i in range(300)], "doc_id long, source string, text string")
    found = mixpacking.packed(docs.unionByName(spark.createDataFrame([(900, None, "none")], docs.schema)), mixpacking.share(spark, PATH),
                              weights={"a": 1, "b": 2, "c": 1}, part=8192)
    rows = mixpacking.pieces(found).groupBy("sequence_id").pivot("source", ["a", "b", "c"]).sum("length").na.fill(0).orderBy("sequence_id").collect()
    table = np.array([r[1:] for r in rows], float)
    first = np.cumsum(table, 0)[7]
    assert np.abs(first / first.sum() - [0.25, 0.5, 0.25]).max() < 0.03  # all three last
    assert table[-1, :2].sum() < table[-1, 2] and mixpacking.phases({"a": 10, "b": 40}, {"a": 1.0, "b": 2.0}, 1000) == [
        ("a", 0, 10, 30, 0, 1), ("b", 0, 20, 30, 0, 1), ("b", 20, 40, 20, 1, 1)]
    check_whole(docs.collect(), [s for s in mixpacking.packed(docs, mixpacking.share(spark, PATH), weights={"a": 3, "b": 1}).collect()], 1024)


def test_round_robin_carries_deficits():
    sequences = mixpacking.rounds([[5000], [300] * 10, [7] * 100], [5000, 3000, 700], [0.0, 0.0, 0.0], 1024, 128)
    assert sum(n for n, _ in sequences) == 8700 and [n for n, _ in sequences][:8] == [1024] * 8
    given = np.zeros(3)
    for n, pieces in sequences[:8]:
        assert sum(p[2] for p in pieces) == n
        for k, _, taken in pieces:
            given[k] += taken
        assert np.abs(given - given.sum() * np.array([5000, 3000, 700]) / 8700).max() <= 2 * 128


def test_text_ids_are_kept(spark):
    docs = spark.createDataFrame([("x", "s", "one two"), (None, None, None)], "doc_id string, source string, text string")
    rows = mixpacking.pieces(mixpacking.packed(docs, mixpacking.share(spark, PATH))).collect()
    assert {(r.doc_id, r.doc_tokens, r.source) for r in rows} == {("x", 3, "s"), (None, 1, None)}
