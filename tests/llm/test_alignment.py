import bisect
import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from turnwarden.llm import alignment, units
from turnwarden.llm.queries import tokenizer

PATHS = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")


def brute(texts):
    """Groups of each text by the libraries: cuts where tokens of both end, then all pairs inside."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_model, b_model = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_model.encode_special_tokens = True
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    of = {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in own)}
    out = []
    for text in texts:
        a = [(i, bytes(of[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()) for i in (b_model.encode(text) if text else [])
             for p in [b_model.id_to_piece(i)]]
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(x[1] for x in a) != whole or b"".join(x[1] for x in b) != whole:
            out.append([])
            continue
        ends = []
        for tokens in (a, b):
            at, e = 0, []
            for i, spelled in tokens:
                at += len(spelled)
                e.append((at, i))
            ends.append(e)
        cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups = [([], []) for _ in cuts]
        for k, side in enumerate(ends):
            for e, i in side:
                groups[bisect.bisect_left(cuts, e)][k].append(i)
        out.append(groups)
    return out


def expected(texts):
    groups = brute(texts)
    held, rows = defaultdict(int), []
    per = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    for links in per:
        for pair in links:
            held[pair] += 1
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for g, links in zip(groups, per):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()),
                     sum(n for p, n in links.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in links.items()),
                     hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows


ODD = [None, "", " ", "\n", "a", "▁", "a ▁b", "  two  spaces ", "<s> </s> <|endoftext|> <0x41>", "tab\tand\r\nline", "héllo wörld naïve", "日本語のテキスト", "🙂🙃" * 5,
       "=" * 3000, "word " * 3000, "x" * 700 + " " * 700, "it's we'll 12345 a.b", "\x00\x01\x7f", "　wide\xa0gap", "same", "same"]


def test_rows_equal_brute_force(spark, tiny, none_left, monkeypatch):
    shared = alignment.share(spark, *PATHS)
    texts = ODD + [r.text for r in tiny.collect()]
    docs = spark.createDataFrame([(None if i == 3 else i % 97, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, n_a string, block int")
    want = Counter((None if i == 3 else i % 97, *row) for i, row in enumerate(expected(texts)))
    assert Counter(map(tuple, alignment.aligned(docs, shared).collect())) == want
    assert alignment.aligned(none_left, shared).count() == 0
    ids = alignment.aligned(docs.selectExpr("concat('d', doc_id) as doc_id", "text").limit(5), shared)
    assert ids.schema["doc_id"].dataType.simpleString() == "string" and ids.count() == 5


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_blocks_and_large_groups(size, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE", 3)
    monkeypatch.setattr(alignment, "ROW", size)
    both = alignment.Tokenizers(*map(units.checked, PATHS))
    digits = alignment.spelled_digits(max(s.count for s in both.spelled))
    block = alignment.Block(7)
    texts = [t or "" for t in ODD]
    for part in (texts[:9], texts[9:]):
        block.add(both, digits, pa.array(range(len(part)), pa.int64()), units.Texts(pa.array([f" {t}" if t else "" for t in part])))
    links = [Counter() for _ in texts]
    at, pair, times = (sum((x[k].tolist() for x in block.links), []) for k in range(3))
    for d, p, n in zip(at, pair, times):
        links[d][p // both.spelled[1].count, p % both.spelled[1].count] += n
    assert links == [Counter((x, y) for a, b in g for x in a for y in b) for g in brute(texts)]


def test_links_in_full():
    both = alignment.Tokenizers(*map(units.checked, PATHS))
    found = alignment.links(["p", "q", "r"], ["naïve words", "", "naïve words"], both)
    assert [f[0] for f in found] == ["p"] * (len(found) // 2) + ["r"] * (len(found) // 2) and found[0][1] == 0
    assert [(f[3], f[4]) for f in found if f[0] == "p"] == brute(["naïve words"])[0] and found[-1][2] == len(" naïve words".encode())


def test_a_worker_holds_little_whatever_it_reads(spark, tiny, monkeypatch):
    """What a worker remembers is bounded below what it may otherwise; blocks are small; the space in front is added to a stretch at a time."""
    found = alignment.Tokenizers(*(units.checked(p) for p in PATHS))
    assert all(u.remembered == alignment.REMEMBERED < units.REMEMBERED for u in found.units)
    seen = []
    spaced = alignment.spaced
    monkeypatch.setattr(alignment, "STRETCH", 1000)
    texts = pa.array(["a b c", None, "", "x" * 3000, " y"])
    for start, end in units.stretches(texts, alignment.STRETCH):
        seen.append(spaced(texts.slice(start, end - start)).to_pylist())
    assert seen == [[" a b c", "", ""], [" " + "x" * 3000], ["  y"]]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = alignment.written_blocks(tiny.select("doc_id", "text"), alignment.share(spark, *PATHS))
    assert spark.conf.get(name) == before
    assert rows.selectExpr("max(size(places))").first()[0] <= alignment.ROW + 100000
