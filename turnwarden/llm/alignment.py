"""Alignment of two tokenizers by interval coalescing, and corpus-wide counts of the id pairs it links.

1. A text, with the space in front that the second model adds, is encoded by a byte-level vocabulary A and a ``sentencepiece`` model
   B. Every token is an interval of bytes. The tokens of both are lexsorted by start; the maximum of the ends so far, accumulated,
   tells where groups break: where a start reaches it, no token spans the place. Within a group the overlaps expand to all pairs
   of an A token and a B token. Documents are aligned many at a time; no Python code runs per token.
2. Documents are taken in blocks of about ``BLOCK`` bytes. A block keeps its links per document as (pair, occurrences), with pairs
   numbered within the block, and a list of its distinct pairs with the documents that hold each. This is written once.
3. The lists, a row per block and pair instead of one per document and pair, are added up to counts, the counts to the highest of
   each A id, and both go back to the blocks that asked, where links are weighed. Neither vocabulary's square nor the counts ever go
   through one task or are broadcast; a pair that stands in every document has a row per block.

Defined results: a null or empty text, or one that either tokenizer does not spell back byte for byte (for instance with the mark
of the model in it), has no tokens: zeros, and an empty digest. Repeated rows are documents of their own; ids keep their type, null
ids too; other columns are not read; strings of special tokens are ordinary text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from turnwarden.llm import units
from turnwarden.sources.shared import settle

#: Bytes of text whose links share a list of pairs, and bytes that are aligned at a time. A block has few distinct pairs (28,000 in 16 MB),
#: so small blocks cost little.
BLOCK, STRETCH = 4 << 20, 1 << 20
#: Bytes of units that a worker remembers for each vocabulary, and documents that it is given at a time.
REMEMBERED, GIVEN = 32 << 20, 1000
#: A group of more pairs is reduced to distinct ids before its overlaps expand.
LARGE = 4096
#: Links per row of a written block, and bytes of rows that are written, and so read, at a time.
ROW, WRITTEN = 1 << 18, 16 << 20


class Side(NamedTuple):
    """Tokens of one vocabulary: ids, places in bytes, and how many tokens each document has."""
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    borders: np.ndarray


class Spelled:
    """The bytes of the ids of a vocabulary."""

    def __init__(self, table: dict[int, bytes]):
        self.count = max(table) + 1
        entries = [table.get(i, b"") for i in range(self.count)]
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(entries), np.uint8)

    def gather(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        ends = np.cumsum(size)
        return self.letters[np.repeat(self.starts[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Tokenizers:
    """Both vocabularies of a worker."""

    def __init__(self, first: bytes, second: bytes):
        self.units = units.byte_level(first, REMEMBERED), units.marked_pieces(second, REMEMBERED)
        self.spelled = (Spelled({i: b for b, i in units.spelled_bytes(first).items()}), Spelled(dict(enumerate(units.spelled_pieces(second)))))

    def encode(self, texts: units.Texts) -> tuple[Side, Side, np.ndarray]:
        """The tokens of both, and which texts both spell back; the others have no tokens."""
        found, good = [], np.diff(texts.borders) > 0
        for own, spelled in zip(self.units, self.spelled):
            ids, borders = own.encode(texts)
            sums = np.append(0, np.cumsum(spelled.sizes[ids]))[borders]
            good &= np.diff(sums) == np.diff(texts.borders)
            letters = spelled.gather(ids)
            if len(letters) == len(texts.data) and np.array_equal(letters, texts.data):
                found.append((ids, borders))
                continue
            for d in np.flatnonzero(good):
                good[d] = np.array_equal(letters[sums[d]:sums[d + 1]], texts.data[texts.borders[d]:texts.borders[d + 1]])
            found.append((ids, borders))
        sides = []
        for (ids, borders), spelled in zip(found, self.spelled):
            counts = np.diff(borders)
            ids = ids[np.repeat(good, counts)]
            counts = np.where(good, counts, 0)
            ends = np.cumsum(spelled.sizes[ids])
            sides.append(Side(ids, ends - spelled.sizes[ids], ends, np.append(0, np.cumsum(counts))))
        return sides[0], sides[1], good


def coalesced(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token."""
    starts, ends = np.concatenate([a.starts, b.starts]), np.concatenate([a.ends, b.ends])
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:len(a.ids)], group[len(a.ids):]


def expanded(ids: tuple, groups: tuple, doc: np.ndarray, codes: int, second: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair, occurrences) of all pairs within groups; ``doc`` is that of each group, a pair is a * second + b.
    ``codes`` is how many pairs there can be."""
    n = [np.bincount(g, minlength=len(doc)) for g in groups]
    weights = [np.ones(len(i), np.int64) for i in ids]
    large = n[0] * n[1] > LARGE
    if large.any():
        ids, groups = list(ids), list(groups)
        for side in (0, 1):
            inside = large[groups[side]]
            key, times = np.unique(groups[side][inside] * (1 << 32) + ids[side][inside], return_counts=True)
            ids[side] = np.concatenate([ids[side][~inside].astype(np.int64), key & 0xFFFFFFFF])
            groups[side] = np.concatenate([groups[side][~inside], key >> 32])
            weights[side] = np.concatenate([weights[side][~inside], times])
            order = np.argsort(groups[side], kind="stable")
            ids[side], groups[side], weights[side] = ids[side][order], groups[side][order], weights[side][order]
        n = [np.bincount(g, minlength=len(doc)) for g in groups]
    each = n[1][groups[0]]
    first = np.cumsum(n[1]) - n[1]
    ends = np.cumsum(each)
    at_a = np.repeat(np.arange(len(each)), each)
    at_b = np.repeat(first[groups[0]] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
    key = doc[groups[0]][at_a] * codes + ids[0][at_a].astype(np.int64) * second + ids[1][at_b]
    times = weights[0][at_a] * weights[1][at_b] if large.any() else None
    if times is None:
        key, times = np.unique(key, return_counts=True)
    else:
        key, of = np.unique(key, return_inverse=True)
        times = np.bincount(of, times, len(key)).astype(np.int64)
    return key // codes, key % codes, times


def written(a: Side, b: Side, groups: tuple[np.ndarray, np.ndarray], digits: np.ndarray) -> list[str]:
    """The digest of every document's groups, written ``a1,a2|b1;a3|b2``. Every id is a row of letters, right-aligned, with what
    follows it in the last place; blanks go."""
    n = [np.bincount(g, minlength=int(groups[0][-1]) + 1 if len(groups[0]) else 0) for g in groups]
    places = np.arange(len(a.ids)) + (np.cumsum(n[1]) - n[1])[groups[0]], np.arange(len(b.ids)) + np.cumsum(n[0])[groups[1]]
    rows = np.empty((len(a.ids) + len(b.ids), digits.shape[1]), np.uint8)
    rows[places[0]], rows[places[1]] = digits[a.ids], digits[b.ids]
    rows[:, -1] = ord(",")
    rows[places[0][np.cumsum(n[0]) - 1], -1] = ord("|")
    rows[places[1][np.cumsum(n[1]) - 1], -1] = ord(";")
    borders = a.borders + b.borders
    rows[borders[1:][borders[1:] > borders[:-1]] - 1, -1] = 0
    shown = rows != 0
    ends = np.append(0, np.cumsum(np.count_nonzero(shown, axis=1)))[borders].tolist()
    letters = memoryview(rows[shown])
    return [hashlib.sha256(letters[s:e]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:])]


def spelled_digits(count: int) -> np.ndarray:
    """The decimal letters of 0..count-1, right-aligned, and one place more."""
    width = len(str(count))
    ids, out = np.arange(count), np.zeros((count, width + 1), np.uint8)
    for k in range(width):
        shown = (ids >= 10 ** k) | (k == 0)
        out[shown, width - 1 - k] = 48 + ids[shown] // 10 ** k % 10
    return out


class Block:
    """Documents aligned so far, and their links."""

    def __init__(self, number: int):
        self.number, self.docs, self.bytes = number, 0, 0
        self.ids: list[pa.Array] = []
        self.columns: list[tuple] = []
        self.links: list[tuple] = []

    def add(self, both: Tokenizers, digits: np.ndarray, doc_ids: pa.Array, texts: units.Texts) -> None:
        a, b, _ = both.encode(texts)
        groups = coalesced(a, b)
        n_docs = len(texts.borders) - 1
        n_groups = int(groups[0][-1]) + 1 if len(a.ids) else 0
        first = np.searchsorted(groups[0], np.arange(n_groups))
        doc = np.searchsorted(a.borders, first, "right") - 1
        codes = both.spelled[0].count * both.spelled[1].count
        at, pair, times = expanded((a.ids, b.ids), groups, doc, codes, both.spelled[1].count)
        links = np.bincount(at, times, n_docs).astype(np.int64)
        self.columns.append((np.diff(a.borders), np.diff(b.borders), np.bincount(doc, minlength=n_docs), links, written(a, b, groups, digits)))
        self.links.append(((at + self.docs).astype(np.int32), pair.astype(np.int64 if codes >> 32 else np.uint32), times.astype(np.int32)))
        self.ids.append(doc_ids)
        self.docs += n_docs
        self.bytes += len(texts.data)

    def rows(self, second: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The list of pairs, then documents with their links."""
        at, pair, times = (np.concatenate([x[k] for x in self.links]) for k in range(3))
        self.links = []
        distinct, place = np.unique(pair, return_inverse=True)
        docs = np.bincount(place, minlength=len(distinct))
        del pair
        columns = [np.concatenate([x[k] for x in self.columns]) for k in range(4)]
        digests = [d for x in self.columns for d in x[4]]
        ids = pa.concat_arrays(self.ids)

        def record(**given) -> pa.RecordBatch:
            values = {"block": pa.array([self.number])} | {
                k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in given.items()}
            return pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(1, f.type)).cast(f.type) for f in schema], schema=schema)

        yield record(a=pa.array((distinct // second).astype(np.int32)), b=pa.array((distinct % second).astype(np.int32)), docs=pa.array(docs.astype(np.int32)))
        start = 0
        sizes = np.bincount(at, minlength=self.docs)
        ends = np.cumsum(sizes)
        while start < self.docs:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + ROW, "right")))
            last = int(ends[stop - 1])
            yield record(doc_ids=ids.slice(start, stop - start), **{k: pa.array(c[start:stop]) for k, c in zip(("n_a", "n_b", "n_groups", "n_links"), columns)},
                         digests=pa.array(digests[start:stop], pa.string()), sizes=pa.array(sizes[start:stop].astype(np.int32)),
                         places=pa.array(place[before:last].astype(np.int32)), times=pa.array(times[before:last].astype(np.int32)))
            start = stop


_BOTH: dict[tuple, tuple[Tokenizers, np.ndarray]] = {}


def _both(shared: tuple[Broadcast, Broadcast]) -> tuple[Tokenizers, np.ndarray]:
    key = tuple(zlib.crc32(s.value) for s in shared)
    if key not in _BOTH:
        _BOTH.clear()
        both = Tokenizers(*(s.value for s in shared))
        _BOTH[key] = both, spelled_digits(max(s.count for s in both.spelled))
    return _BOTH[key]


def share(spark: SparkSession, first: str, second: str) -> tuple[Broadcast, Broadcast]:
    """Both vocabulary files for the executors, of checked size."""
    return tuple(spark.sparkContext.broadcast(units.checked(path)) for path in (first, second))


def spaced(texts: pa.Array) -> pa.Array:
    """The texts with the space in front that the second model adds; null and empty ones are empty."""
    texts = pc.fill_null(texts, "")
    return pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")))


def blocks(docs: DataFrame, shared: tuple[Broadcast, Broadcast]) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its links, by blocks; see the head of this module."""
    kinds = {"a": T.IntegerType(), "b": T.IntegerType(), "docs": T.IntegerType(), "doc_ids": docs.schema["doc_id"].dataType, "n_a": T.LongType(),
             "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "digests": T.StringType(), "sizes": T.IntegerType(),
             "places": T.IntegerType(), "times": T.IntegerType()}
    schema = T.StructType([T.StructField("block", T.LongType()), *(T.StructField(k, T.ArrayType(t)) for k, t in kinds.items())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, digits = _both(shared)
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for start, end in units.stretches(texts, STRETCH):
                block.add(both, digits, ids.slice(start, end - start), units.Texts(spaced(texts.slice(start, end - start))))
                if block.bytes >= BLOCK:
                    yield from block.rows(both.spelled[1].count, arrow)
                    number += 1
                    block = Block(number)
        if block.docs:
            yield from block.rows(both.spelled[1].count, arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def written_blocks(docs: DataFrame, shared: tuple[Broadcast, Broadcast]) -> DataFrame:
    """``blocks``, written: workers are given ``GIVEN`` documents at a time, and tasks write and read ``WRITTEN`` bytes of rows at a time."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(GIVEN))
    try:
        return settle(blocks(docs, shared), "align-blocks", **{"parquet.block.size": WRITTEN})
    finally:
        conf.set(name, before)


def pair_counts(found: DataFrame) -> DataFrame:
    """Per id pair that a document links: a, b, ``count``, the documents that hold it, and whether no pair of its A id has more."""
    listed = found.filter("a is not null").select(F.explode(F.arrays_zip("a", "b", "docs")).alias("x")).select("x.*")
    counts = settle(listed.groupBy("a", "b").agg(F.sum("docs").alias("count")), "align-counts")
    return counts.join(counts.groupBy("a").agg(F.max("count").alias("most")), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def weighed(doc_rows: pa.Table, answers: pa.Table, schema: pa.Schema) -> pa.Table:
    """The documents of one block with the counts of their links."""
    count, best = np.zeros(answers.num_rows, np.int64), np.zeros(answers.num_rows, np.int64)
    place = answers.column("place").to_numpy()
    count[place], best[place] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
    out = []
    for row in doc_rows.to_batches(max_chunksize=1):
        values = {f.name: row.column(f.name).flatten() for f in row.schema if f.name != "block"}
        places, times = values["places"].to_numpy(), values["times"].to_numpy()
        borders, sums = np.append(0, np.cumsum(values["sizes"].to_numpy())), {}
        for name, of in (("n_best", best), ("count_sum", count)):
            upto = np.append(0, np.cumsum(of[places] * times))  # exact, where a weighted count in doubles would not be
            sums[name] = pa.array(upto[borders[1:]] - upto[borders[:-1]])
        out.append(pa.RecordBatch.from_arrays([values["doc_ids"], values["n_a"], values["n_b"], values["n_groups"], values["n_links"],
                                               sums["n_best"], sums["count_sum"], values["digests"]], schema=schema))
    return pa.Table.from_batches(out, schema=schema)


def aligned(docs: DataFrame, shared: tuple[Broadcast, Broadcast], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = written_blocks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shared)
    asked = found.filter("a is not null").select("block", F.posexplode(F.arrays_zip("a", "b")).alias("place", "x")).select("block", "place", "x.a", "x.b")
    answers = asked.join(pair_counts(found), ["a", "b"]).select(F.col("block").alias("asked_by"), "place", "count", "best")
    rows = found.filter("doc_ids is not null").select("block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "sizes", "places", "times")
    schema = T.StructType([T.StructField("doc_id", found.schema["doc_ids"].dataType.elementType), *(
        T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), T.StructField("groups_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)
    return rows.groupBy("block").cogroup(answers.groupBy("asked_by")).applyInArrow(lambda a, b: weighed(a, b, arrow), schema)


def links(doc_ids: list, texts: list[str | None], both: Tokenizers) -> list[tuple]:
    """The groups of a few texts in full, for a look: ``(doc_id, start, end, A ids, B ids)``, places in bytes of space + text."""
    given = units.Texts(pa.array([f" {t}" if t else "" for t in texts], pa.string()))
    a, b, _ = both.encode(given)
    groups = coalesced(a, b)
    out = []
    for g in range(int(groups[0][-1]) + 1 if len(a.ids) else 0):
        in_a, in_b = np.flatnonzero(groups[0] == g), np.flatnonzero(groups[1] == g)
        d = int(np.searchsorted(a.borders, in_a[0], "right") - 1)
        base = int(a.starts[a.borders[d]])
        out.append((doc_ids[d], int(a.starts[in_a[0]]) - base, int(a.ends[in_a[-1]]) - base, a.ids[in_a].tolist(), b.ids[in_b].tolist()))
    return out
