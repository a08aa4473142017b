"""Token ids packed into rows of fixed length, best fit first, and written as binary matrices.

Texts become ids of a public byte-level vocabulary. Documents longer than a row are cut into chunks of a row's length, so
nothing is lost. Chunks are gathered in groups of about ``GROUP`` ids as a task reads them; in a group they are placed from
long to short, each into the row with the least room that still holds it. Rows are found in a segment tree over room sizes.

A packed row holds its ids (unsigned 16-bit, little-endian, filled up with ``PAD``), the cumulative lengths of its segments,
one bit per place that is set where positions begin again at 0, and the document and chunk of each segment.

No shuffle; a group is all that a task holds, and a task that is run again gives the same rows. Defined results: a null or
empty text is one segment of length 0; a null id is kept as null; rows of one id are told apart by nothing else than their
order; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession

from turnwarden.llm.pieces import MOST_BYTES, stretches

LENGTH, GROUP = 2048, 2_000_000
#: The id that fills a row; the vocabulary leaves it free.
PAD = 50256
#: The pattern that cuts text before merges, and a coarser one whose borders are among its own.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
REMEMBERED = 500_000
SCHEMA = ("shard int, part int, row int, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, resets binary, "
          "doc_ids array<long>, chunks array<int>")
ARROW = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("row", pa.int32()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()),
                   ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("resets", pa.binary()),
                   ("doc_ids", pa.list_(pa.int64())), ("chunks", pa.list_(pa.int32()))])


def load(path: str) -> bytes:
    import os
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MOST_BYTES} bytes)")
    with open(path, "rb") as f:
        return f.read()


class Tokens:
    """Texts to ids. Units between white space are encoded once and remembered."""

    def __init__(self, ranks: bytes):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.encoding = tiktoken.Encoding("packed", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, bytes] = {}

    def unit(self, unit: str) -> bytes:
        if (ids := self.known.get(unit)) is None:
            ids = np.array(self.encoding.encode_ordinary(unit), "<u2").tobytes()
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.unit, UNITS.findall(text)))


class Rooms:
    """A segment tree over the sizes 0..length of free room: the smallest size not below a bound that some row has."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.filled = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self.count(room, 1)

    def count(self, room: int, by: int) -> None:
        i = self.width + room
        while i:
            self.filled[i] += by
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """``(room, row)`` with the least room that is at least ``least``; of such rows the latest."""
        i = self.width + least
        while not self.filled[i]:
            while i & 1:  # a right child, or the root: climb until there is a right neighbour
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.width:
            i = 2 * i if self.filled[2 * i] else 2 * i + 1
        room = i - self.width
        row = self.rows[room].pop()
        self.count(room, -1)
        return room, row


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """The indices of ``lengths`` in rows of at most ``length``: from long to short, each where the least room is left."""
    rows: list[list[int]] = []
    rooms = Rooms(length)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[i])
        if found is None:
            found = length, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(i)
        rooms.add(room - lengths[i], row)
    return rows


def pack(chunks: list[tuple[int | None, int, bytes]], length: int, shard: int, part: int) -> pa.RecordBatch:
    """Chunks ``(doc_id, chunk, ids)`` as packed rows."""
    out = []
    for number, members in enumerate(best_fit([len(c[2]) // 2 for c in chunks], length)):
        ends = np.cumsum([0] + [len(chunks[i][2]) // 2 for i in members])
        ids = b"".join(chunks[i][2] for i in members)
        resets = np.zeros(length, np.uint8)
        resets[ends[:-1][ends[:-1] < ends[1:]]] = 1
        out.append({"shard": shard, "part": part, "row": number, "n_tokens": int(ends[-1]), "n_segments": len(members),
                    "ids": ids + np.full(length - int(ends[-1]), PAD, "<u2").tobytes(), "cu_seqlens": ends.tolist(),
                    "resets": np.packbits(resets).tobytes(), "doc_ids": [chunks[i][0] for i in members], "chunks": [chunks[i][1] for i in members]})
    return pa.RecordBatch.from_pylist(out, schema=ARROW)


_TOKENS: list[Tokens] = []


def share(spark: SparkSession, path: str) -> Broadcast:
    """The ranks for the executors; their size is checked when they are read."""
    return spark.sparkContext.broadcast(load(path))


def packed(docs: DataFrame, shared: Broadcast, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Packed rows of all documents, as described by ``SCHEMA``; (shard, part, row) tells them apart."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _TOKENS:
            _TOKENS.append(Tokens(shared.value))
        held: list[tuple[int | None, int, bytes]] = []
        size = part = 0
        shard = TaskContext.get().partitionId()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in stretches(texts):
                for key, value in zip(keys[start:end], texts[start:end]):
                    ids = _TOKENS[0].encode(value or "")
                    for n, at in enumerate(range(0, max(len(ids), 1), 2 * length)):
                        held.append((key, n, ids[at:at + 2 * length]))
                        size += len(held[-1][2]) // 2
                        if size >= group:
                            yield pack(held, length, shard, part)
                            held, size, part = [], 0, part + 1
        if held:
            yield pack(held, length, shard, part)

    return docs.selectExpr(f"cast(`{doc_id}` as long) as doc_id", f"`{text}` as text").mapInArrow(rows, SCHEMA)


def write(docs: DataFrame, path: str, shared: Broadcast, **named) -> None:
    """The packed rows of ``docs`` as Parquet with binary columns."""
    packed(docs, shared, **named).write.parquet(path)


def matrix(ids: bytes, length: int = LENGTH) -> np.ndarray:
    """The ids of packed rows, joined, as a matrix."""
    return np.frombuffer(ids, "<u2").reshape(-1, length)


def positions(cu_seqlens: list[int], length: int = LENGTH) -> np.ndarray:
    """The position of every place within its segment; padding counts on from 0."""
    out = np.arange(length)
    for start in cu_seqlens:
        out[start:] = np.arange(length - start)
    return out
