"""Mixture-controlled packing: deficit round-robin over queues of sources fills every window to target token proportions.

1. Texts become ids of a byte-level vocabulary, each followed by ``END``, and are written once. A document stands in the queue of
   its source behind the documents read before it; its place in the queue is the tokens in front of it, from counts per task
   and source, so no queue is ever sorted or gathered.
2. Queues are cut into parts of about ``PART`` tokens that all hold the target proportions: of a queue of L tokens, part p of P
   takes the places from floor((p L + o) / P) to floor(((p + 1) L + o) / P), with an offset o < P of its own that spreads the
   ends of many short queues. A document across a border is cut, so a part is bounded however long a document or large a source
   is. What a part owes a queue, the fraction of a token that rounding left, is the deficit that the next part begins with.
3. In a part, every window of ``LENGTH`` tokens adds its share to the deficit of each queue. Queues are visited in turn, the first
   one moving on from window to window; a queue gives what its deficit covers once that reaches ``GRAIN`` tokens or the end of its
   document. Room that is left goes to the queues with the largest deficits, in debt if need be. Deficits, debts included, carry
   over to the next window, so no source strays by more than a few grains from its target however many windows are filled.
4. What does not fill a window at the end of a part is cut into sequences whose lengths are powers of two: nothing is padded.

The proportions are those of the corpus, for which every queue lasts to the end. With ``weights`` of sources the windows follow the
weights as long as all sources last, and those of the sources that are left from each point where one runs dry.

Defined results: a null or empty text is its end id alone; null ids are kept and repeated ids are rows of their own; a null source
is a queue like others; ids keep their type; other columns are not read; an empty table gives no rows. Every id of every document
lies in exactly one piece. Special strings in a text are ordinary text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwarden.llm import units
from turnwarden.sources.shared import new_folder, settle

LENGTH, GRAIN, PART = 1024, 128, 1 << 20
#: The id behind every document.
END = 0
_UNITS: dict[int, units.Units] = {}


def share(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file for the executors; its size is checked when it is read."""
    return spark.sparkContext.broadcast(units.checked(path))


def width(shared: Broadcast) -> int:
    """Bytes of an id: 2 where all ids of the vocabulary fit, else 4."""
    return 2 if max(units.spelled_bytes(shared.value).values()) < 1 << 16 else 4


def _encoder(shared: Broadcast) -> units.Units:
    key = zlib.crc32(shared.value)
    if key not in _UNITS:
        _UNITS.clear()
        _UNITS[key] = units.byte_level(shared.value)
    return _UNITS[key]


def compressed(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder, packed closer than tables usually are: ids hold far less than their bits."""
    path = new_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def queue(source: Column) -> Column:
    """A name without nulls for the queue of a source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tokenised(docs: DataFrame, shared: Broadcast, wide: int) -> DataFrame:
    """Per row of ``docs`` (queue, doc_id, text): queue, doc_id, the task that read it, the tokens of its queue in front of it
    in that task, its number of tokens n and its ids of ``wide`` bytes, the end id among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ahead, task = _encoder(shared), {}, TaskContext.get().partitionId()
        for batch in batches:
            for start, end in units.stretches(batch.column("text")):
                rows = batch.slice(start, end - start)
                ids, borders = encoder.encode(units.Texts(rows.column("text")))
                n = np.diff(borders) + 1
                after = np.cumsum(n)
                out = np.full(int(after[-1]), END, f"<u{wide}")
                keep = np.ones(len(out), bool)
                keep[after - 1] = False
                out[keep] = ids
                before = np.zeros(len(n), np.int64)
                names, of = np.unique(rows.column("queue").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    at = np.flatnonzero(of == k)
                    sums = np.cumsum(n[at])
                    before[at] = ahead.get(name, 0) + sums - n[at]
                    ahead[name] = ahead.get(name, 0) + int(sums[-1])
                data = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, after * wide).astype(np.int32)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([rows.column("queue"), rows.column("doc_id"), pa.array(np.full(len(n), task), pa.int32()),
                                                  pa.array(before), pa.array(n), data], ["queue", "doc_id", "task", "ahead", "n", "ids"])

    schema = T.StructType([T.StructField("queue", T.StringType()), docs.schema["doc_id"], T.StructField("task", T.IntegerType()),
                           T.StructField("ahead", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select("queue", "doc_id", "text").mapInArrow(run, schema)


def phases(tokens: dict[str, int], weights: dict[str, float], part: int) -> list[tuple]:
    """Stretches of queues in which the same queues last: ``(queue, low, high, of all, first part, parts)``. A queue is dry after
    tokens / weight units of time; between two such points every queue that lasts gives tokens by its weight."""
    rows, low, first = [], dict.fromkeys(tokens, 0), 0
    for time in sorted({tokens[q] / weights[q] for q in tokens}):
        high = {q: tokens[q] if tokens[q] / weights[q] <= time else min(tokens[q], int(weights[q] * time)) for q in tokens}
        total = sum(high[q] - low[q] for q in tokens)
        if total:
            parts = -(-total // part)
            rows += [(q, low[q], high[q], total, first, parts) for q in tokens if low[q] < high[q]]
            first += parts
        low = high
    return rows


def plan(counts: DataFrame, weights: Mapping[str | None, float] | None, part: int) -> DataFrame:
    """Where the tokens of each queue go: ``queue, low, high, total, first, parts``. With ``weights``, sources that they do not
    name form one queue of weight 1, so the driver holds as many rows as the caller gave weights."""
    totals = counts.groupBy("queue").agg(F.sum("tokens").alias("high"))
    if weights is None:
        total = int(totals.agg(F.sum("high")).first()[0] or 0)
        return totals.select("queue", F.lit(0).cast("long").alias("low"), "high", F.lit(total).cast("long").alias("total"),
                             F.lit(0).cast("long").alias("first"), F.lit(-(-total // part)).cast("long").alias("parts"))
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    named = {"" if s is None else f"={s}": float(w) for s, w in weights.items()}
    tokens = {r["queue"]: r["high"] for r in totals.collect()}
    rows = phases(tokens, {q: named.get(q, 1.0) for q in tokens}, part)
    return counts.sparkSession.createDataFrame(rows, "queue string, low long, high long, total long, first long, parts long")


def dealt(docs: DataFrame, weights: Mapping[str | None, float] | None, part: int, wide: int) -> DataFrame:
    """The pieces of tokenised documents by parts: part, queue, share (of the windows), owed (by the parts before), place in the
    queue, doc_id, start, ids, doc_tokens."""
    counts = settle(docs.groupBy("task", "queue").agg(F.sum("n").alias("tokens")), "mixpack-counts")
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ways = counts.withColumn("before", before).join(plan(counts, weights, part), "queue").withColumn(
        "shift", F.pmod(F.xxhash64("queue", "low"), F.col("parts")))
    whole = "decimal(38,0)"
    rows = docs.join(ways.drop("tokens"), ["task", "queue"]).withColumn("place", F.col("before") + F.col("ahead")).filter(
        "place < high and place + n > low").withColumns({
            "long": F.col("high") - F.col("low"), "from": F.greatest("place", "low") - F.col("low"),
            "to": F.least(F.col("place") + F.col("n"), "high") - F.col("low")})

    def part_of(q: str) -> Column:
        return F.expr(f"cast((cast({q} + 1 as {whole}) * parts - shift - 1) div long as bigint)")

    def border(p: str) -> Column:
        return F.expr(f"cast((cast({p} as {whole}) * long + shift) div parts as bigint)")

    rows = rows.withColumn("p", F.explode(F.sequence(part_of("from"), part_of("(to - 1)")))).withColumns(
        {"begin": F.greatest(F.col("from"), border("p")), "end": F.least(F.col("to"), border("(p + 1)"))}).filter("begin < end")
    owed = F.expr(f"(cast((cast(p as {whole}) * long + shift) % parts as double) - shift) / parts")
    start = F.col("begin") + F.col("low") - F.col("place")
    return rows.withColumns({"start": start, "size": F.col("end") - F.col("begin")}).select(
        (F.col("first") + F.col("p")).alias("part"), "queue", (F.col("long") / F.col("total")).alias("share"), owed.alias("owed"),
        (F.col("place") + F.col("start")).alias("place"), "doc_id", "start",
        F.expr(f"substring(ids, cast({wide} * start + 1 as int), cast({wide} * size as int))").alias("ids"), F.col("n").alias("doc_tokens"))


def rounds(sizes: list[list[int]], shares: list[float], owed: list[float], length: int, grain: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The sequences of a part, as ``(length, pieces)`` with pieces ``(queue, document, tokens)``: ``sizes`` are those of the
    documents of each queue, which is served in order."""
    left, heads = [list(s) for s in sizes], [0] * len(sizes)
    alive = sum(map(sum, sizes))
    deficit, out, first = list(owed), [], 0
    scale = sum(shares) or 1.0

    def take(k: int, most: int) -> int:
        d = heads[k]
        n = min(left[k][d], most)
        pieces.append((k, d, n))
        left[k][d] -= n
        deficit[k] -= n
        if not left[k][d]:
            heads[k] += 1
        return n

    while alive:
        window = length if alive >= length else 1 << (alive.bit_length() - 1)
        room, pieces = window, []
        for k, share in enumerate(shares):
            deficit[k] += window * share / scale
        for turn in range(len(sizes)):
            k = (first + turn) % len(sizes)
            while room and heads[k] < len(left[k]) and deficit[k] >= min(grain, left[k][heads[k]]):
                room -= take(k, min(int(deficit[k]), room))
        while room:
            k = max((k for k in range(len(sizes)) if heads[k] < len(left[k])), key=deficit.__getitem__)
            room -= take(k, min(grain, room))
        first = (first + 1) % len(sizes)
        alive -= window
        out.append((window, pieces))
    return out


def fill(table: pa.Table, length: int, grain: int, wide: int, schema: pa.Schema) -> pa.Table:
    """The sequences of one part."""
    table = table.sort_by([("queue", "ascending"), ("place", "ascending")]).combine_chunks()
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), f"<u{wide}")
    size = pc.binary_length(table.column("ids")).to_numpy() // wide
    at = np.cumsum(size) - size
    names = table.column("queue").combine_chunks().dictionary_encode()
    queues = names.indices.to_numpy()
    firsts = np.searchsorted(queues, np.arange(len(names.dictionary) + 1))
    share, owed, start = (table.column(c).to_numpy() for c in ("share", "owed", "start"))
    sequences = rounds([size[a:b].tolist() for a, b in zip(firsts, firsts[1:])], share[firsts[:-1]].tolist(), owed[firsts[:-1]].tolist(), length, grain)
    flat = np.array([piece for _, pieces in sequences for piece in pieces], np.int64).reshape(-1, 3)
    row, taken = firsts[flat[:, 0]] + flat[:, 1], flat[:, 2]
    # How much of a document earlier pieces took: pieces of one document follow one another.
    order = np.argsort(row, kind="stable")
    sums = np.cumsum(taken[order]) - taken[order]
    inside = np.empty(len(row), np.int64)
    inside[order] = sums - np.repeat(sums[np.searchsorted(row[order], np.arange(len(size)))], np.bincount(row, minlength=len(size)))
    begin = at[row] + inside
    letters = memoryview(ids.astype("<u4")).cast("B")
    crcs = [zlib.crc32(letters[4 * a:4 * (a + n)]) for a, n in zip(begin.tolist(), taken.tolist())]
    total = int(taken.sum())
    gathered = ids[np.repeat(begin - (np.cumsum(taken) - taken), taken) + np.arange(total)]
    lengths, counts = np.array([n for n, _ in sequences]), np.array([len(pieces) for _, pieces in sequences])
    token_ends, piece_ends = np.append(0, np.cumsum(lengths)), np.append(0, np.cumsum(counts)).astype(np.int32)
    offset = np.cumsum(taken) - taken - np.repeat(token_ends[:-1], counts)

    def lists(values) -> pa.Array:
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return pa.ListArray.from_arrays(pa.array(piece_ends), values)

    part = int(table.column("part")[0].as_py())
    return pa.Table.from_arrays([
        pa.array(np.arange(len(lengths)) + (part << 32)), pa.array(lengths, pa.int32()),
        pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer((token_ends * wide).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(gathered))]),
        lists(table.column("doc_id").take(pa.array(row))), lists(pa.array(start[row] + inside)), lists(pa.array(taken)), lists(pa.array(offset)),
        lists(pa.array(crcs, pa.int64())), lists(table.column("doc_tokens").take(pa.array(row))), lists(table.column("queue").take(pa.array(row))),
    ], schema=schema)


def packed(docs: DataFrame, shared: Broadcast, doc_id: str = "doc_id", source: str = "source", text: str = "text", length: int = LENGTH,
           grain: int = GRAIN, part: int = PART, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """A row per sequence: sequence_id, n_tokens, ids (little-endian, as many bytes each as ``width`` tells), and per piece, in order,
    the arrays doc_ids, starts, lengths, offsets, crcs (of ids of 4 bytes), doc_tokens and queues. ``n_tokens`` is ``length`` or a
    power of two below it."""
    if length < 1 or length & (length - 1):
        raise ValueError("the length must be a power of two")
    wide = width(shared)
    name = F.col(source).cast("string")
    named = F.lit(True) if weights is None else F.coalesce(name.isin([s for s in weights if s is not None]), F.lit(None in weights))
    rows = compressed(tokenised(docs.select(F.when(named, queue(name)).otherwise(F.lit("other")).alias("queue"), F.col(doc_id).alias("doc_id"),
                                            F.col(text).alias("text")), shared, wide), "mixpack-ids")
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("ids", T.BinaryType()),
                           *(T.StructField(name, T.ArrayType(t)) for name, t in (
                               ("doc_ids", kind), ("starts", T.LongType()), ("lengths", T.LongType()), ("offsets", T.LongType()),
                               ("crcs", T.LongType()), ("doc_tokens", T.LongType()), ("queues", T.StringType())))])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return dealt(rows, weights, part, wide).groupBy("part").applyInArrow(lambda table: fill(table, length, grain, wide, arrow), schema)


def pieces(sequences: DataFrame) -> DataFrame:
    """A row per piece of packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    zipped = F.arrays_zip("doc_ids", "starts", "lengths", "offsets", "crcs", "doc_tokens", "queues")
    name = F.col("x.queues")
    return sequences.select("sequence_id", F.explode(zipped).alias("x")).select(
        F.col("x.doc_ids").alias("doc_id"), F.col("x.starts").alias("start"), F.col("x.lengths").alias("length"), F.col("x.crcs").alias("ids_crc32"),
        F.col("x.doc_tokens").alias("doc_tokens"), "sequence_id", F.col("x.offsets").alias("offset"),
        F.when(name.startswith("="), F.substring(name, 2, 1 << 30)).when(name != "", name).alias("source"))
