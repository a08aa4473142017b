"""Repeated passages: every byte covered by a string of ``SPAN`` bytes that also starts somewhere else.

The starts of all strings are too many to sort (eight bytes for a place alone are several times the text), so the places that
are compared are sampled by a cover. A fixed difference cover samples residues, so that any two places have a common distance to
sampled ones; here the sample depends on the text: of the grams in each string the one with the least hash is sampled. Two
equal strings are therefore sampled at the same distance, which is what the cover is for, and one place in about 75 is enough.

1. The starts that share a sampled gram form a block. Blocks are named by the gram, which all their strings hold (the core),
   and by everything that their strings cover (the hull).
2. Names are counted. A hull that occurs twice settles all starts of its blocks; a core that occurs once settles them too: no
   other place holds their strings.
3. What is left, the blocks at the borders of repeats, is cut into pieces at equal distances from the sampled gram, and the
   names of the pieces are treated in the same way: pieces of ``PIECE`` starts, then single starts, where core and hull are
   the string itself and equal names lie side by side. A settled hull is represented by one of its blocks.
4. The strings found are merged to runs of bytes, per text.

A place is known by a 128-bit hash of its text and the offset, so equal texts share their results. Names are counted before
anything is joined to them, rounds are written to the shared folder, and no group is gathered but the pieces of one text.

Defined results: a null text is empty; texts shorter than ``SPAN`` keep all bytes; matches do not cross texts; a text repeated
by another row is removed if it is long enough; null ids and other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwarden.llm.minhash import mix
from turnwarden.llm.text import forgotten, parted, released

SPAN, GRAM, PIECE = 200, 48, 8
REACH = SPAN - GRAM + 1
#: Starts of a text that are taken at a time.
SEGMENT = 1 << 20
SUB = "d1 long, d2 long, pos long, core long, hull long, settled boolean"
_ARROW = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("pos", pa.int64()), ("core", pa.int64()), ("hull", pa.int64()), ("settled", pa.bool_())])

_BASE = 0x9E3779B97F4A7C15
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base % 2**64))
    out[0] = 1
    return np.cumprod(out)


_POWERS: list[np.ndarray] = []


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place, from running sums modulo 2^64 that are brought to a common power."""
    if not _POWERS or len(_POWERS[0]) <= len(data):
        n = max(len(data) + 1, SEGMENT + 2 * SPAN)
        _POWERS[:] = [_powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data] * _POWERS[1][:len(data)])])
    return mix((sums[GRAM:] - sums[:-GRAM]) * _POWERS[0][:len(data) - GRAM + 1])


def least_places(hashes: np.ndarray) -> np.ndarray:
    """For each start the place of the least hash within ``REACH`` places, the leftmost of equals: minima of runs of ``REACH``
    places from the left and from the right make up those of any window."""
    keys = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
    n = len(keys) - REACH + 1
    runs = np.concatenate([keys, np.full(-len(keys) % REACH, 2**64 - 1, np.uint64)]).reshape(-1, REACH)
    right = np.minimum.accumulate(runs[:, ::-1], axis=1)[:, ::-1].ravel()
    left = np.minimum.accumulate(runs, axis=1).ravel()
    return (np.minimum(right[:n], left[REACH - 1:REACH - 1 + n]) & np.uint64(2**24 - 1)).astype(np.int64)


def short_name(data, salt: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=8, salt=salt).digest()


def place(start: int, count: int, before: int) -> int:
    """Start, number of starts, and distance from the first start to the sampled gram in one number."""
    return start << 16 | count << 8 | before


def blocks(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per segment of a text: places, cores and hulls of its blocks."""
    for base in range(0, len(text) - SPAN + 1, SEGMENT):
        part = memoryview(text)[base:base + SEGMENT + SPAN - 1]
        hashes = gram_hashes(np.frombuffer(part, np.uint8))
        least = least_places(hashes)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        count = np.diff(np.concatenate([first, [len(least)]]))
        before = least[first] - first
        hulls = b"".join(short_name(part[s:s + c - 1 + SPAN], bytes((b,))) for s, c, b in zip(first.tolist(), count.tolist(), before.tolist()))
        yield (first + base) << 16 | count << 8 | before, hashes[least[first]].view(np.int64), np.frombuffer(hulls, np.int64)


def pieces(text: bytes, wanted: list[dict], size: int) -> Iterator[tuple[int, int, int, bool]]:
    """The wanted parts of a text cut at distances from the sampled gram that ``size`` divides: place, core, hull, settled.
    The core of a piece is what any string from these distances holds, so pieces cut short compare with whole ones."""
    data = memoryview(text)
    for w in wanted:
        start, count, before = w["pos"] >> 16, w["pos"] >> 8 & 255, w["pos"] & 255
        anchor, nearest = start + before, before - count + 1
        for part in range(nearest // size, before // size + 1):
            low, high = max(nearest, part * size), min(before, part * size + size - 1)
            salt = w["core"].to_bytes(8, "little", signed=True) + bytes((part,))
            core = short_name(data[anchor - part * size:anchor - (part * size + size - 1) + SPAN], salt)
            hull = short_name(data[anchor - high:anchor - low + SPAN], bytes((low, high)))
            yield place(anchor - high, high - low + 1, high), int.from_bytes(core, "little", signed=True), int.from_bytes(hull, "little", signed=True), w["settled"]


def level(docs: DataFrame, wanted: DataFrame | None, size: int) -> DataFrame:
    """Names of all blocks, or of the pieces of what is wanted. ``docs`` has d1, d2 and the bytes."""
    def all_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d1, d2, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for pos, core, hull in blocks(text):
                    n = len(pos)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, d1)), pa.array(np.full(n, d2)), pa.array(pos), pa.array(core), pa.array(hull),
                                                      pa.array(np.zeros(n, bool))], schema=_ARROW)

    def all_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = list(zip(*pieces(row["text"], row["wanted"], size)))
                n = len(found[0])
                yield pa.RecordBatch.from_arrays([pa.array([row["d1"]] * n), pa.array([row["d2"]] * n), *(pa.array(x) for x in found)], schema=_ARROW)

    def gathered(function):
        """Small batches are sent on together."""
        def run(batches):
            held, n = [], 0
            for b in function(batches):
                held.append(b)
                n += b.num_rows
                if n >= 50_000:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, n = [], 0
            if n:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return run

    if wanted is None:
        return docs.select("d1", "d2", "text").mapInArrow(gathered(all_blocks), SUB)
    # Equal texts give equal pieces, which count once.
    return parted(docs, wanted, "d1", "d2")[0].join(wanted, ["d1", "d2"]).select("d1", "d2", "text", "wanted").mapInArrow(gathered(all_pieces), SUB).distinct()


def repeated(docs: DataFrame) -> DataFrame:
    """``d1, d2, runs``: for each text with repeats the sorted, disjoint ranges (struct of start and end) of bytes in them."""
    wanted, places = None, []
    for size in (0, PIECE, 1):
        cores = level(docs, wanted, size)
        if wanted is not None:
            cores = released(cores, "suffix-pieces")
            forgotten(wanted)
        shared = released(cores.groupBy("core").count().filter("count > 1").select("core"), "suffix-cores")
        open_ = released(cores.join(shared, "core"), "suffix-open")
        forgotten(shared, *([] if wanted is None else [cores]))
        hulls = released(open_.groupBy("core", "hull").agg(F.count("*").alias("n"), F.min(F.struct("settled", "d1", "d2", "pos")).alias("one")), "suffix-hulls")
        twice = open_.join(hulls.filter("n > 1").select("core", "hull"), ["core", "hull"], "left_semi").filter("not settled")
        places.append(released(twice.select("d1", "d2", "pos").distinct(), "suffix-found"))
        if size == 1:
            forgotten(open_, hulls)
            break
        # A hull is open if it occurs once and is not known to repeat; its core's other hulls are what it may match.
        known = (F.col("n") > 1) | F.col("one.settled")
        active = hulls.filter(~known).select("core").distinct()
        rest = hulls.join(active, "core").select("one.d1", "one.d2", F.struct(F.col("one.pos").alias("pos"), "core", known.alias("settled")).alias("w"))
        wanted = released(rest.groupBy("d1", "d2").agg(F.collect_list("w").alias("wanted")), "suffix-wanted")
        forgotten(open_, hulls)
    found = places[0].unionByName(places[1]).unionByName(places[2])
    start, count = F.shiftright("pos", 16), F.shiftright("pos", 8).bitwiseAND(255)
    ranges = found.select("d1", "d2", F.struct(start.alias("start"), (start + count - 1 + SPAN).alias("end")).alias("r")).distinct()
    runs = released(ranges.groupBy("d1", "d2").agg(F.sort_array(F.collect_list("r")).alias("runs")), "suffix-runs")
    forgotten(*places)
    return runs


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` as one struct, with the bytes of the text and the two halves of their hash."""
    full = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("_doc"), full.alias("_full")).select(
        "_doc", F.xxhash64("_full").alias("d1"), F.xxhash64(F.lit(SPAN), "_full").alias("d2"), F.col("_full").cast("binary").alias("text"))


def merged(ranges: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in ranges or ():
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def removed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as the struct ``_doc`` with n_bytes, n_removed, n_spans, kept_sha256, and ``kept``, the remaining bytes where
    any were removed (else null)."""
    rows = keyed(docs, text)
    runs = repeated(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                kept, spans = [], []
                for value, ranges in zip(part.column("text").to_pylist(), part.column("runs").to_pylist()):
                    spans.append(merged([(r["start"], r["end"]) for r in ranges or ()]))
                    ends = [0, *(x for s in spans[-1] for x in s), len(value)]
                    kept.append(b"".join(value[a:b] for a, b in zip(ends[::2], ends[1::2])))
                texts = part.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    part.column("_doc"), pa.array(list(map(len, texts)), pa.int64()), pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                    pa.array(list(map(len, spans)), pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                    pa.array([k if s else None for k, s in zip(kept, spans)], pa.binary())],
                    ["_doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    # Texts without repeats are whole, and stay where they are read.
    some, others = parted(rows, runs, "d1", "d2")
    joined = some.join(runs, ["d1", "d2"], "left").select("_doc", "text", "runs")
    kind = joined.schema["_doc"].dataType.simpleString()
    none = F.lit(0).cast("long")
    whole = others.select("_doc", F.length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
                          F.sha2("text", 256).alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    return joined.mapInArrow(cut, f"_doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").unionByName(whole)


def deduplicated(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` without the repeated bytes. A cut inside a character drops what is left of it; texts of which nothing is left go."""
    rest = F.col("kept").cast("string")
    whole = F.coalesce(F.try_validate_utf8(rest), F.regexp_replace(F.make_valid_utf8(rest), "\ufffd", ""))
    kinds = {f.name: f.dataType for f in docs.schema}
    new = F.when(F.col("kept").isNotNull(), whole).otherwise(F.col(f"_doc.{text}"))
    out = removed(docs, text).filter("kept is null or length(kept) > 0").withColumn("_new", new)
    names = {text: F.col("_new"), **({n_chars: F.length("_new").cast(kinds[n_chars])} if n_chars in kinds else {})}
    return out.select(*[(names[c] if c in names else F.col(f"_doc.{c}")).alias(c) for c in docs.columns])
