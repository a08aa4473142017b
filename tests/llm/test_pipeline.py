import random
import re
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from turnwarden.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(9)

    def prose(n):
        return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.2 else "".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))
    passage = prose(70)
    rows = [(i, prose(rng.randint(60, 200)), "en", f"s{i % 3}", 0) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s0", 0) for i in range(5)]  # copies
    rows += [(200 + i, rows[i][1] + " more words at the end", "en", "s0", 0) for i in range(5, 10)]  # near copies
    rows += [(300 + i, prose(80) + " " + passage + " " + prose(80), "en", "s1", 0) for i in range(4)]
    rows += [(400, "too short", "en", "s0", 0), (401, None, None, None, None), (402, "#### " * 50, "en", "s2", 0)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    return folder, {r[0]: r[1] for r in rows}, passage


def test_stages(spark, planted):
    folder, texts, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/step{k}"
        stage(spark, docs, folder).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
        steps[name] = [r.asDict() for r in docs.collect()]
    good = {r["doc_id"] for r in steps["quality_rules"]}
    assert good == set(texts) - {400, 401, 402}
    assert {r["doc_id"] for r in steps["minhash_near_dedup"]} == good - set(range(100, 105)) - set(range(205, 210))
    cut = {r["doc_id"]: r["text"] for r in steps["suffix_array_dedup"]}
    assert all(cut[i] == texts[i] for i in range(40))
    # Where neighbours of the passage agree by chance, a few letters more are cut.
    assert all(len(texts[i]) - len(passage) - 6 <= len(cut[i]) <= len(texts[i]) - len(passage) and passage[:60] not in cut[i] for i in range(300, 304))
    size, out = defaultdict(int), defaultdict(int)
    for r in steps["suffix_array_dedup"]:
        size[r["source"]] += len(r["text"].split())
    for r in steps["source_mixing"]:
        out[r["source"]] += len(r["text"].split())
        assert r["text"] == cut[r["doc_id"]] or len(r["text"]) < len(cut[r["doc_id"]])
    total = sum(size.values())
    for i, s in enumerate(sorted(size)):
        assert abs(out[s] - total * (i + 1) / 6) < 0.02 * total
    assert max(Counter(r["doc_id"] for r in steps["source_mixing"]).values()) <= 3
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    want = sorted((r["doc_id"], tuple(library.encode(r["text"]))) for r in steps["source_mixing"])
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in steps["sentencepiece_encoding"]) == want
    assert all(r["round_trip"] for r in steps["sentencepiece_encoding"])


def test_run_and_empty(spark, planted, tmp_path):
    folder, _, _ = planted
    assert corpus_pipeline.run(spark, folder).count() > 0
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_words_survive_mixing(spark, planted):
    folder, texts, _ = planted
    out = corpus_pipeline.source_mixing(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    for r in out:
        assert set(re.findall(r"\S+", r.text or "")) <= set((texts[r.doc_id] or "").split())
