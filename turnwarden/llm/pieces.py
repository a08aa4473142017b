"""SentencePiece encoding and decoding, with work shared between words of a common prefix.

Text is marked (a space becomes the mark, one mark goes in front) and cut where no piece can cross: between letters that no piece
holds side by side, which is before every run of marks, around line ends and between most words and their punctuation (``units``).
The distinct words of a batch that are not known yet are sorted, which lays out
their trie, and traversed depth-first: a stack holds one forward state per letter of the current word, and the next word keeps the
states of the prefix the two share.

The state depends on the model. For a unigram model it is the best summed score of a prefix and the piece that ends it
(Viterbi). The public model is of the other kind, byte-pair merges, for which the best sum gives other pieces than the merges
do; there the state is the last piece of the prefix's own encoding. A piece can follow the state's piece only if merging the
letters of both would leave the two apart, which their own last merges tell, and exactly one piece passes.

Rows are independent and nothing is shuffled. Defined results: a null or empty text has no pieces and decodes to empty;
letters without a piece become byte pieces; repeated rows and null ids are rows like others; other columns pass through, and
those that carry a name the operator returns are replaced.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwarden.llm import units

MARK = "▁"
#: Ids decoded (and characters cut, for other operators) at a time, and pairs of pieces remembered by a worker.
STRETCH, REMEMBERED = 2_000_000, 400_000
#: A vocabulary file is read whole by the driver; it must be one.
MOST_BYTES = 64 << 20


class Vocabulary(NamedTuple):
    pieces: list[str]
    scores: list[float]
    first_byte: int  # the id of the byte piece <0x00>
    kind: str  # merges or unigram


def load(path: str, kind: str = "merges") -> Vocabulary:
    """The pieces of a model file with byte pieces. ``kind`` tells how it was made, which the file's reader does not."""
    import os

    import sentencepiece
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MOST_BYTES} bytes)")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    own = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    return Vocabulary([model.id_to_piece(i) if own[i] else "" for i in range(n)], [model.get_score(i) for i in range(n)],
                      model.piece_to_id("<0x00>"), kind)


class Encoder:
    """Words to ids. ``prefix`` states live only while a sorted list of words is traversed."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ids = {p: i for i, p in enumerate(vocabulary.pieces) if p}
        self.longest = max(map(len, self.ids))
        self.together = self.joinable()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.units = units.Units(self.encode_words, self.cuts)
        self.bytes_of = {p: np.array([i], "<i4").tobytes() for p, i in self.ids.items()}
        self.spelled: tuple | None = None
        self.unknown_score = min(vocabulary.scores) - 10
        if vocabulary.kind == "merges":
            self.derive()

    def merge(self, word: str, trace: list[str] | None = None) -> list[str]:
        """Pieces by merging neighbours: always the pair whose union has the highest score, the leftmost of equals. ``trace``
        takes the left part of every merge."""
        parts: list[str | None] = list(word)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(parts)
            if i >= 0 and j < len(parts) and (k := self.ids.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-self.v.scores[k], i, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, union = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != union:
                continue
            if trace is not None:
                trace.append(parts[i])
            parts[i], parts[j] = union, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def derive(self) -> None:
        """How each piece comes about: the two parts of its last merge, and the rank of that merge (letters: -1). Pieces that
        merging does not give back from their letters are never the result of an encoding."""
        order = sorted((i for i, p in enumerate(self.v.pieces) if p), key=lambda i: (-self.v.scores[i], i))
        ranks = dict(zip(order, range(len(order))))
        self.rank, self.parts, self.whole = {}, {}, set()
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.rank[piece], self.parts[piece] = -1, None
                self.whole.add(piece)
                continue
            self.rank[piece] = ranks[i]
            last: list[str] = []
            if self.merge(piece, last) == [piece]:
                self.parts[piece] = (last[-1], piece[len(last[-1]):])
                self.whole.add(piece)
        self.reach = {}  # of a letter: the longest piece that it ends
        for piece in self.whole:
            self.reach[piece[-1]] = max(self.reach.get(piece[-1], 0), len(piece))

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay as they are. Their merges are undone from the last one on: if the pieces that
        then meet could be merged before what was undone, they would have been (equal ranks go from the left)."""
        if (known := self.pairs.get((left, right))) is not None:
            return known
        a, b, limit, known = left, right, float("inf"), True
        while True:
            union = self.ids.get(a + b)
            if union is not None and self.rank[a + b] < limit:
                known = False
                break
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.parts[a][1]
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, self.parts[b][0]
            else:
                break
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        self.pairs[left, right] = known
        return known

    def fits(self, left: str, piece: str) -> bool:
        """Whether ``piece`` can follow the state ``left``; anything follows the beginning and a letter without a piece."""
        if left not in self.whole:
            return True
        known = self.pairs.get((left, piece))
        return known if known is not None else self.stay_apart(left, piece)

    def step_merges(self, word: str, i: int, last: list[str]) -> str:
        """The piece that ends the first ``i`` letters; a letter without a piece stands for itself. Exactly one piece fits, so the
        likely ones come first: the last piece with the letter added, and the letter alone."""
        letter, whole = word[i - 1], self.whole
        if letter not in whole:
            return letter
        before = last[i - 1]
        longer = before + letter
        if longer in whole and before and self.fits(last[i - len(longer)], longer):
            return longer
        if self.fits(before, letter):
            return letter
        for length in range(min(self.reach[letter], i), 1, -1):
            piece = word[i - length:i]
            if piece in whole and self.fits(last[i - length], piece):
                return piece
        raise ValueError(f"no piece ends {word[:i]!r}")

    def step_unigram(self, word: str, i: int, best: list[float]) -> tuple[float, str]:
        """The best sum for the first ``i`` letters and its last piece."""
        found = max(((best[i - n] + self.v.scores[self.ids[word[i - n:i]]], n) for n in range(1, min(self.longest, i) + 1)
                     if word[i - n:i] in self.ids), default=None)
        if found is None or word[i - 1] not in self.ids and best[i - 1] + self.unknown_score > found[0]:
            found = (best[i - 1] + self.unknown_score, 1)
        return found[0], word[i - found[1]:i]

    def learn(self, words: set[str]) -> None:
        """Encode words depth-first along their sorted order."""
        merges = self.v.kind == "merges"
        # Runs of marks are merged last of all, so a word is what follows them, with one mark.
        runs = {w: len(w) - len(w.lstrip(MARK)) for w in words if merges and w.startswith(MARK * 2)}
        cores = {w[n - 1:] for w, n in runs.items()}
        last, best, previous = [""], [0.0], ""
        known, bytes_of, whole, pairs, step = self.known, self.bytes_of, self.whole if merges else (), self.pairs, self.step_merges
        for word in sorted((words - runs.keys()) | (cores - known.keys())):
            same = 0
            for a, b in zip(word, previous):
                if a != b:
                    break
                same += 1
            del last[same + 1:], best[same + 1:]
            before = last[same]
            for i in range(same + 1, len(word) + 1):
                if merges:
                    # The likeliest piece, the last one with the letter added, is tried here; ``step`` tries all.
                    piece = before + word[i - 1]
                    if not before or piece not in whole or not pairs.get((last[i - len(piece)], piece)):
                        piece = step(word, i, last)
                else:
                    score, piece = self.step_unigram(word, i, best)
                    best.append(score)
                last.append(piece)
                before = piece
            previous, i, found = word, len(word), []
            while i:
                piece = last[i]
                found.append(bytes_of.get(piece) or self.fallback(piece))
                i -= len(piece)
            found.reverse()
            known[word] = b"".join(found)
        mark = bytes_of.get(MARK)
        for w, n in runs.items():
            core = known[w[n - 1:]]
            alone = core[:4] == mark  # the last mark is not part of a longer piece
            known[w] = b"".join(bytes_of[p] for p in self.merge(MARK * (n if alone else n - 1))) + (core[4:] if alone else core)

    def fallback(self, letter: str) -> bytes:
        """The byte pieces of a letter without a piece."""
        return np.array([self.v.first_byte + b for b in letter.encode("utf-8", "surrogatepass")], "<i4").tobytes()

    def joinable(self) -> np.ndarray:
        """Which two bytes may stand next to each other in a piece; letters of several bytes are never torn apart."""
        out = np.zeros((256, 256), bool)
        out[:, 0x80:0xC0] = True
        for piece in self.ids:
            letters = np.frombuffer(piece.replace(MARK, " ").encode("utf-8", "surrogatepass"), np.uint8)
            out[letters[:-1], letters[1:]] = True
        return out

    def cuts(self, t: units.Texts) -> np.ndarray:
        """Between letters that no piece holds side by side: neither merges nor the best sum can join what stands there."""
        cut = np.zeros(len(t.data), bool)
        cut[1:] = ~self.together[t.data[:-1], t.data[1:]]
        return cut

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that were not met before, 4 bytes each."""
        marked = [w.decode().replace(" ", MARK) for w in words]
        self.known = {}
        self.learn(set(marked))
        out = [self.known[w] for w in marked]
        self.known = {}
        return out

    def encode(self, texts: pa.Array | list[str | None]) -> pa.ListArray:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" "), pc.replace_substring(texts, MARK, " "), pa.scalar("")))
        offsets, values = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        for start, end in units.stretches(texts):
            ids, borders = self.units.encode(units.Texts(texts.slice(start, end - start)))
            values.append(ids.astype(np.int32))
            offsets.append(offsets[-1][-1] + borders[1:])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(np.concatenate(values)))

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of rows of ids, which follow one another up to ``ends``: all bytes are gathered at once from the pieces' bytes."""
        if self.spelled is None:
            table = [p.replace(MARK, " ").encode() for p in self.v.pieces]
            for b in range(256):
                table[self.v.first_byte + b] = bytes([b])
            sizes = np.array([len(t) for t in table])
            self.spelled = np.frombuffer(b"".join(table), np.uint8), np.cumsum(sizes) - sizes, sizes
        letters, starts, sizes = self.spelled
        size = sizes[ids]
        after = np.concatenate([[0], np.cumsum(size)])
        data = letters[np.repeat(starts[ids] - after[:-1], size) + np.arange(after[-1])]
        borders = after[np.concatenate([[0], ends])]
        heads = borders[:-1][borders[:-1] < borders[1:]]
        mark = heads[data[heads] == 32]  # the mark put in front
        keep = np.ones(len(data), bool)
        keep[mark] = False
        borders = borders - np.concatenate([[0], np.cumsum(~keep)])[borders]
        data = data[keep].tobytes()
        firsts = np.frombuffer(data, np.uint8)[borders[:-1][borders[:-1] < borders[1:]]]
        try:
            data.decode()
            whole = not ((firsts >= 0x80) & (firsts < 0xC0)).any()
        except UnicodeDecodeError:
            whole = False
        if whole:
            return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(borders.astype(np.int64).tobytes()), pa.py_buffer(data)).cast(pa.string())
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(borders.tolist(), borders[1:].tolist())], pa.string())


def stretches(texts: list[str | None]):
    """Ranges of texts that hold about ``STRETCH`` characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= STRETCH:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared: Broadcast) -> Encoder:
    """The worker's encoder for a vocabulary, with the words it remembers; one at a time."""
    key = hash((shared.value.kind, len(shared.value.pieces), shared.value.pieces[-1], sum(map(len, shared.value.pieces))))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def encoder(shared: Broadcast):
    """The function of a text column that gives the ids of its pieces."""
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _encoder(shared).encode(texts)
    return encode


def decoder(shared: Broadcast):
    """The function of an id column that gives the text."""
    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        texts, start = [], 0
        sizes = np.array(ids.value_lengths().fill_null(0))
        values, ends = ids.flatten().to_numpy(), np.cumsum(sizes)
        while start < len(sizes):  # as many rows as make up a stretch, at least one
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + STRETCH)))
            texts.append(_encoder(shared).decode(values[before:ends[stop - 1]], ends[start:stop] - before))
            start = stop
        return pa.concat_arrays(texts) if texts else pa.array([], pa.string())
    return decode


def share(spark: SparkSession, path: str, kind: str = "merges") -> Broadcast:
    """The vocabulary for the executors; its size is checked when it is read."""
    return spark.sparkContext.broadcast(load(path, kind))


def encode(docs: DataFrame, shared: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``n_pieces``."""
    out = docs.withColumn("ids", encoder(shared)(F.col(text)))
    return out.withColumn("n_pieces", F.size("ids").cast("long"))


def plain(text: Column) -> Column:
    """What decoding gives back: the text, in which a mark of its own is read as a space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), MARK, " ")
