"""Texts to token ids through their distinct units.

A batch of texts is one buffer of bytes. It is cut at places that no token spans whatever stands around them; the pieces
between cuts, the units, are told apart by Arrow's dictionary encoding, only units not met before are given to the tokenizer,
and the ids of the batch are gathered from the units' ids. No Python code runs per word or per token.

A worker remembers units up to a number of bytes and forgets all of them beyond it; texts are taken in stretches of bytes.
Both bound its memory whatever the texts are; a unit may be as long as a text.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text taken at a time, and bytes of units and their ids that a worker remembers.
STRETCH, REMEMBERED = 8 << 20, 128 << 20
#: Bytes that a remembered unit takes besides its letters and ids.
ENTRY = 120

SPACE, LINE = 0x20, 0x0A
MARK = "▁"


class Texts:
    """Bytes of texts that follow one another: ``data`` and the ``borders`` between texts."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "") if texts.null_count else texts
        borders = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        data = texts.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[borders[0]:borders[-1]] if data is not None else np.zeros(0, np.uint8)
        self.borders = (borders - borders[0]).astype(np.int64)


def stretches(texts: pa.Array, size: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes, at least one text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, stop
        start = stop


def _shifted(data: np.ndarray, by: int) -> np.ndarray:
    """What stands ``by`` bytes earlier; 0 in front of the data."""
    out = np.zeros_like(data)
    out[by:] = data[:len(data) - by] if by < len(data) else data[:0]
    return out


def byte_level_cuts(t: Texts) -> np.ndarray:
    """Cuts for the pattern of byte-level vocabularies: before a space or a line end that follows what is surely no white space,
    and after a single line end between two such letters. White space beyond ASCII has no lead byte in C3..DF."""
    data, one, two = t.data, _shifted(t.data, 1), _shifted(t.data, 2)
    wide = (two >= 0xC3) & (two <= 0xDF) & (one >= 0x80)
    solid = ((one > SPACE) & (one < 0x7F)) | wide
    opens = ((data > SPACE) & (data < 0x7F)) | ((data >= 0xC3) & (data <= 0xDF))
    cut = ((data == SPACE) | (data == LINE)) & solid
    cut |= opens & (one == LINE) & np.concatenate([np.zeros(min(1, len(cut)), bool), cut[:-1]])
    return cut


def marked_cuts(t: Texts) -> np.ndarray:
    """Cuts for vocabularies whose pieces hold the mark only in front: before a run of spaces. A mark in the text (its last byte
    is 81) belongs to the run."""
    one = _shifted(t.data, 1)
    return (t.data == SPACE) & (one != SPACE) & (one != 0x81)


class Units:
    """Units met so far with their ids, and texts encoded by way of them. ``encode`` gives the ids of units as lists of numbers, or as
    bytes, 4 to an id."""

    def __init__(self, encode: Callable[[list[bytes]], list], cuts: Callable[[Texts], np.ndarray], remembered: int = REMEMBERED):
        self.encode_units, self.cuts, self.remembered = encode, cuts, remembered
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.used = self.held = 0

    def learn(self, units: list[bytes]) -> None:
        found = self.encode_units(units)
        n, sizes = len(self.places), np.fromiter(map(len, found), np.int64, len(found))
        packed = isinstance(found[0], bytes)
        sizes = sizes // 4 if packed else sizes
        total = int(sizes.sum())
        while n + len(units) > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used:self.used + total] = np.frombuffer(b"".join(found), "<u4") if packed else np.fromiter(
            itertools.chain.from_iterable(found), np.uint32, total)
        self.starts[n:n + len(units)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + len(units)] = sizes
        self.places.update(zip(units, range(n, n + len(units))))
        self.used += total
        self.held += sum(map(len, units)) + 4 * total + ENTRY * len(units)

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the borders between texts among them."""
        cut = self.cuts(t)
        cut[t.borders[:-1][t.borders[:-1] < len(cut)]] = True
        at = np.append(np.flatnonzero(cut), len(cut)).astype(np.int32)
        if len(at) == 1:
            return np.zeros(0, np.uint32), np.zeros(len(t.borders), np.int64)
        units = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(t.data))]).dictionary_encode()
        distinct = units.dictionary.to_numpy(zero_copy_only=False)
        if self.held > self.remembered:
            self.forget()
        known = np.fromiter((self.places.get(u, -1) for u in distinct), np.int64, len(distinct))
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = np.arange(len(self.places), len(self.places) + len(new))
            self.learn(distinct[new].tolist())
        place = known[units.indices.to_numpy()]
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[place] - (ends - sizes), sizes) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.searchsorted(at, t.borders)]


#: The pattern that cuts text before merges, in byte-level vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A vocabulary file is read whole by the driver; it must be one.
MOST_BYTES = 64 << 20


def checked(path: str) -> bytes:
    """A vocabulary file's content, of checked size."""
    import os
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MOST_BYTES} bytes)")
    with open(path, "rb") as f:
        return f.read()


def spelled_bytes(vocabulary: bytes) -> dict[bytes, int]:
    """The bytes of every entry of a byte-level vocabulary (JSON) and its id. Entries are written in letters that stand for
    bytes: printable bytes of Latin-1 for themselves, the others by letters from 256 on, in order."""
    model = json.loads(vocabulary)["model"]
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    others = [b for b in range(256) if b not in own]
    of = {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}
    return {bytes(map(of.__getitem__, entry)): i for entry, i in model["vocab"].items()}


def byte_level(vocabulary: bytes, remembered: int = REMEMBERED) -> Units:
    """A byte-level vocabulary in the JSON form of the ``tokenizers`` library, special strings being ordinary text.

    Where merges are numbered in the order in which they apply, a merge table is a table of ranks, and ids are found by a
    library that knows ranks and no places in the text, many times as fast; else by the library that the file was made for.
    """
    model = json.loads(vocabulary)["model"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    first = len(model["vocab"]) - len(pairs)
    if all(model["vocab"].get(a + b) == first + k for k, (a, b) in enumerate(pairs)):
        import tiktoken
        ranked = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=spelled_bytes(vocabulary), special_tokens={})
        return Units(lambda units: [ranked.encode_ordinary(u.decode()) for u in units], byte_level_cuts, remembered)
    from tokenizers import Tokenizer
    slow = Tokenizer.from_buffer(vocabulary)
    slow.encode_special_tokens = True
    return Units(lambda units: [e.ids for e in slow.encode_batch([u.decode() for u in units], add_special_tokens=False)], byte_level_cuts, remembered)


def marked_pieces(vocabulary: bytes, remembered: int = REMEMBERED) -> Units:
    """A model of ``sentencepiece`` that changes no letters. Texts are given with the space in front that the model would add."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(vocabulary)
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model changes letters or spaces before it cuts")
    if any(MARK in p.piece.lstrip(MARK) for p in model.pieces):
        raise ValueError("a piece holds the mark behind other letters")
    spec.add_dummy_prefix = False
    own = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    return Units(lambda units: own.encode([u.decode() for u in units], num_threads=1), marked_cuts, remembered)


def spelled_pieces(vocabulary: bytes) -> list[bytes]:
    """The bytes that each piece of a ``sentencepiece`` model stands for."""
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(vocabulary)
    return [bytes([int(p.piece[1:-1], 16)]) if p.type == p.BYTE else p.piece.replace(MARK, " ").encode() for p in model.pieces]
