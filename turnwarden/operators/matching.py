"""Terms of a table looked up where the text is, without a row per gram: for tables that a task can hold.

The table is sent to the tasks; texts are taken as bytes, some ``STRETCH`` of them at a time, and no Python code runs per place:

* ``Substrings``: the eight bytes at each place (fewer for shorter terms) are one number; a bit map says which may begin a term, the sorted
  beginnings which do, and the rest of the term is compared eight bytes at a time. Places in UTF-8 are places of characters.
* ``Words``: terms of word characters alone stand where a whole run of word characters is the term, so only distinct runs are looked up.

A table of more than ``MOST`` characters goes through the join of ``dictionary``. Both give the same rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden.sources.shared import settle

#: Characters of a table that tasks hold; bytes of text taken at a time; entries of lists that are written at a time.
MOST, STRETCH, ENTRIES = 192 << 20, 2 << 20, 1 << 20
#: The first bytes of a term that are one number.
KEY = 8


def held(entries: DataFrame) -> tuple[DataFrame, pa.Table | None]:
    """``entries`` (ord, term, shown) written, and as a table of (term, shown) by (ord, shown, term), each row once; no table if it is too large."""
    entries = settle(entries, "terms")
    size = entries.agg(F.sum(F.length("term") + F.length("shown") + 16).alias("n")).first()["n"] or 0
    if size > MOST:
        return entries, None
    return entries, entries.distinct().orderBy("ord", "shown", "term").select("term", "shown").toArrow()


class Bytes:
    """The bytes of an array of texts, with zeros behind them, and the borders between texts."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2]
        self.size = int(borders[-1] - borders[0])
        self.padded = np.zeros(self.size + KEY, np.uint8)
        if self.size:
            self.padded[:self.size] = np.frombuffer(data, np.uint8)[borders[0]:borders[-1]]
        self.data, self.borders = self.padded[:self.size], borders - borders[0]

    def numbers(self) -> np.ndarray:
        """At every place, the eight bytes from there on as a number."""
        return np.ndarray((self.size + 1,), "<u8", self.padded.data, strides=(1,))

    def texts_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, at, "right") - 1


def readable(texts: pa.Array) -> pa.Array:
    """``texts`` with the mark of unknown characters for bytes that are none."""
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:
        return pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()], pa.string())


def stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``STRETCH`` bytes, at least one text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + STRETCH, "right")))
        yield start, stop
        start = stop


class Substrings:
    """Places of terms in texts, wherever they stand. ``codes`` are the numbers of the terms, none of them empty."""

    def __init__(self, terms: pa.Array, codes: np.ndarray):
        own = Bytes(terms)
        self.own, self.starts, self.sizes, self.codes = own, own.borders[:-1], np.diff(own.borders), codes
        numbers, self.groups = own.numbers(), []
        for k in np.unique(np.minimum(self.sizes, KEY)).tolist():
            members = np.flatnonzero(np.minimum(self.sizes, KEY) == k)
            keys = numbers[self.starts[members]] & self.mask(k)
            order = np.argsort(keys, kind="stable")
            distinct, first, count = np.unique(keys[order], return_index=True, return_counts=True)
            shift = np.uint64(64 - min(24, max(12, int(len(distinct)).bit_length() + 4)))
            table = np.zeros(1 << (64 - int(shift)), bool)
            table[self.place(distinct, shift)] = True
            self.groups.append((self.mask(k), shift, table, distinct, first, count, members[order]))

    @staticmethod
    def mask(k: int) -> np.uint64:
        return np.uint64(2 ** (8 * k) - 1)

    @staticmethod
    def place(keys: np.ndarray, shift: np.uint64) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> shift

    def found(self, texts: Bytes, where: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The text, the place in all bytes, the size and the number of every term that stands in a text, at the places ``where`` if given."""
        numbers, out = texts.numbers(), []
        for mask, shift, table, distinct, first, count, members in self.groups:
            given = numbers[:-1] if where is None else numbers[where]
            may = np.flatnonzero(table[self.place(given & mask, shift)])
            key = given[may] & mask
            at = may if where is None else where[may]
            which = np.minimum(np.searchsorted(distinct, key), len(distinct) - 1)
            same = distinct[which] == key
            at, which = at[same], which[same]
            each = count[which]
            ends = np.cumsum(each)
            member = members[np.repeat(first[which] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
            at = np.repeat(at, each)
            text = texts.texts_of(at)
            good = at + self.sizes[member] <= texts.borders[text + 1]
            at, member, text = at[good], member[good], text[good]
            out.append(self.compared(numbers, at, member, text))
        text, at, member = (np.concatenate([x[k] for x in out]) for k in range(3)) if out else (np.zeros(0, np.int64),) * 3
        return text, at, self.sizes[member], self.codes[member]

    def compared(self, numbers: np.ndarray, at: np.ndarray, member: np.ndarray, text: np.ndarray) -> tuple:
        """Those whose bytes behind the first eight are the term's, too."""
        own, done = self.own.numbers(), KEY
        good = np.ones(len(at), bool)
        rest = np.flatnonzero(self.sizes[member] > done)
        while len(rest):
            left = np.minimum(self.sizes[member[rest]] - done, KEY).astype(np.uint64)
            mask = np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left)
            same = (numbers[at[rest] + done] & mask) == (own[self.starts[member[rest]] + done] & mask)
            good[rest[~same]] = False
            done += KEY
            rest = rest[same]
            rest = rest[self.sizes[member[rest]] > done]
        return text[good], at[good], member[good]


class Listed:
    """Terms, each with the places of its entries among all entries, and what entries show. ``words``: terms begin and end where words do."""

    def __init__(self, table: pa.Table, words: bool, once: bool):
        encoded = table["term"].combine_chunks().dictionary_encode()
        codes = encoded.indices.to_numpy().astype(np.int64)
        self.shown = table["shown"].combine_chunks()
        self.of_shown = self.shown.dictionary_encode().indices.to_numpy() if once else None
        if once and len(np.unique(self.of_shown)) == len(self.of_shown):
            self.of_shown = None
        self.entries = np.argsort(codes, kind="stable")
        self.counts = np.bincount(codes, minlength=len(encoded.dictionary))
        self.firsts = np.cumsum(self.counts) - self.counts
        terms = encoded.dictionary.cast(pa.large_binary())
        size = pc.binary_length(terms).to_numpy(zero_copy_only=False)
        self.empty = np.flatnonzero(size == 0)
        whole = self._fit_words(terms, np.asarray(size)) if words else np.zeros(len(terms), bool)
        rest = np.flatnonzero(~whole & (size > 0))
        self.rest = Substrings(terms.take(pa.array(rest)), rest) if len(rest) else None

    def _fit_words(self, terms: pa.Array, size: np.ndarray) -> np.ndarray:
        """Prepare the terms that are word characters alone; which they are."""
        import xxhash
        own = Bytes(terms)
        whole = size > 0
        for start in range(0, len(whole), 1 << 16):
            borders = own.borders[start:start + (1 << 16) + 1]
            outside = np.append(0, np.cumsum(~word_bytes(own.data[borders[0]:borders[-1]])))
            whole[start:start + (1 << 16)] &= np.diff(outside[borders - borders[0]]) == 0
        at = np.flatnonzero(whole)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in terms.take(pa.array(at)).to_pylist()), np.uint64, len(at))
        order = np.argsort(hashes, kind="stable")
        hashes, at = hashes[order], at[order]
        # Terms of one hash, should there be any, are found as substrings.
        alone = np.ones(len(at), bool)
        alone[1:] &= hashes[1:] != hashes[:-1]
        alone[:-1] &= hashes[1:] != hashes[:-1]
        whole[at[~alone]] = False
        self.hashes, self.by_hash = hashes[alone], at[alone]
        self.terms, self.shortest, self.longest = terms.take(pa.array(self.by_hash)), int(size[whole].min(initial=1)), int(size[whole].max(initial=0))
        return whole

    def joined(self, text: np.ndarray, code: np.ndarray, n: int, between: str) -> pa.Array:
        """What the entries of the terms found in each of ``n`` texts show, in order; null for none. Repeats change nothing."""
        pairs = np.unique(text * max(len(self.counts), 1) + code)
        text, code = np.divmod(pairs, max(len(self.counts), 1))
        upto = np.append(0, np.cumsum(self.counts[code]))
        borders = np.searchsorted(text, np.arange(n + 1))
        out, start = [], 0
        while start < n:
            stop = max(start + 1, int(np.searchsorted(upto[borders], upto[borders[start]] + ENTRIES, "right")) - 1)
            some = slice(borders[start], borders[stop])
            each = self.counts[code[some]]
            ends = np.cumsum(each)
            rank = self.entries[np.repeat(self.firsts[code[some]] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
            key = np.sort((np.repeat(text[some], each) - start) * max(len(self.entries), 1) + rank)
            of, rank = np.divmod(key, max(len(self.entries), 1))
            if self.of_shown is not None:
                _, first = np.unique(of * len(self.entries) + self.of_shown[rank], return_index=True)
                first.sort()
                of, rank = of[first], rank[first]
            ends = np.searchsorted(of, np.arange(stop - start + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.shown.take(pa.array(rank)))
            out.append(pc.if_else(pa.array(np.diff(borders[start:stop + 1]) > 0), pc.binary_join(lists, between), pa.scalar(None, pa.string())))
            start = stop
        return pa.concat_arrays(out) if out else pa.array([], pa.string())


@functools.cache
def letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point, whether it is a word character, and the character that stands for all it equals in any case; 2**32 - 1
    where that one is not of the same kind."""
    kinds = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Nd", "Mn", "Mc", "Me", "Pc"}
    word, fold = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    # No letters are assigned beyond these.
    for c in [*range(0x40000), *range(0xE0000, 0xE0200)]:
        x = chr(c)
        word[c] = unicodedata.category(x) in kinds
        if x.upper() != x or x.lower() != x:
            upper = x.upper() if len(x.upper()) == 1 else x
            fold[c] = ord(upper.lower()) if len(upper.lower()) == 1 else c
    # Joiners, and letters in circles or squares.
    for first, last in ((0x200C, 0x200D), (0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189)):
        word[first:last + 1] = True
    fold[word != word[fold]] = 2**32 - 1
    return word, fold


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8, and for each byte which of them it belongs to."""
    if not (data >= 0x80).any():
        return data.astype(np.uint32), np.arange(len(data), dtype=np.int32)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.cumsum((data & 0xC0) != 0x80, dtype=np.int32) - 1


def word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to word characters."""
    points, of = code_points(data)
    return letters()[0][points][of]


def whole_words(listed: Listed, low: Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text, place, size and number of every term that begins and ends where a word does."""
    import xxhash
    inside = word_bytes(low.data)
    if not low.size:
        return (np.zeros(0, np.int64),) * 4
    before = np.append(False, inside)  # whether a word character stands before the place, in the same text
    before[low.borders] = False
    after = np.append(inside, False)
    starts = np.flatnonzero(after[:-1] & ~before[:-1])
    closes = np.zeros(low.size + 1, bool)
    closes[1:] = inside & ~after[1:]
    inner = low.borders[1:][low.borders[1:] > 0]
    closes[inner] |= inside[inner - 1]
    stops = np.flatnonzero(closes)
    out = []
    if len(listed.by_hash):
        size = stops - starts
        fits = (size >= listed.shortest) & (size <= listed.longest)
        at, size = starts[fits], size[fits]
        upto = np.append(0, np.cumsum(size))
        letters_at = np.repeat(at - upto[:-1], size) + np.arange(upto[-1])
        runs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(low.data[letters_at])]).dictionary_encode()
        distinct = runs.dictionary
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
        place = np.minimum(np.searchsorted(listed.hashes, hashes), len(listed.hashes) - 1)
        good = np.flatnonzero(listed.hashes[place] == hashes)
        equal = pc.equal(distinct.take(pa.array(good)).cast(pa.large_binary()), listed.terms.take(pa.array(place[good]))).to_numpy(zero_copy_only=False)
        code = np.full(len(distinct) + 1, -1, np.int64)
        code[good[equal]] = listed.by_hash[place[good[equal]]]
        code = code[runs.indices.to_numpy()]
        hit = code >= 0
        out.append((low.texts_of(at[hit]), at[hit], size[hit], code[hit]))
    if listed.rest is not None:
        border = np.flatnonzero(before[:-1] != after[:-1])
        text, at, size, code = listed.rest.found(low, border)
        stop = at + size
        follows = after[stop] & (stop < low.borders[text + 1])
        good = inside[stop - 1] != follows
        out.append((text[good], at[good], size[good], code[good]))
    return tuple(np.concatenate([x[k] for x in out]) for k in range(4)) if out else (np.zeros(0, np.int64),) * 4


def first_longest(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of matches that may overlap, those that begin first and of these are longest, each after the end of the one before."""
    order = np.lexsort((-size, at))
    if not (at[order][1:] < (at + size)[order][:-1]).any():
        return order
    kept, reach = [], -1
    for i, start, stop in zip(order.tolist(), at[order].tolist(), (at + size)[order].tolist()):
        if start >= reach:
            kept.append(i)
            reach = stop
    return np.array(kept, np.int64)


def unlike(texts: Bytes, low: Bytes) -> np.ndarray:
    """Which texts do not equal their lower case letter by letter, in any case."""
    out = np.diff(texts.borders) != np.diff(low.borders)
    keep = ~out
    a, b = (texts, low) if keep.all() else ([t.data[np.repeat(keep, np.diff(t.borders))] for t in (texts, low)])
    if keep.all():
        a, b = a.data, b.data
    borders = np.append(0, np.cumsum(np.diff(low.borders)[keep]))
    differ = ((a & 0xC0) != 0x80) != ((b & 0xC0) != 0x80)
    if not differ.any():
        (x, of), (y, _) = code_points(a), code_points(b)
        differ = (letters()[1][x] != y)[of]
    out[np.flatnonzero(keep)[np.searchsorted(borders, np.flatnonzero(differ), "right") - 1]] = True
    return out


def scrubbed_alone(text: str, names: list[str], replacement: str) -> str:
    """``text`` with the names replaced, whole words in any case, letter by letter."""
    word, fold = letters()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def folded(s: str) -> str:
        given = np.frombuffer(s.encode("utf-32-le"), np.uint32)
        return np.where(fold[given] == 2**32 - 1, given, fold[given]).astype("<u4").tobytes().decode("utf-32-le")

    low, inside = folded(text), np.concatenate([[False], word[points], [False]])
    border = inside[1:] != inside[:-1]
    found = []
    for name in {folded(n) for n in names}:
        at = low.find(name)
        while at >= 0:
            if border[at] and border[at + len(name)]:
                found.append((at, len(name)))
            at = low.find(name, at + 1)
    if not found:
        return text
    at, size = np.array(found, np.int64).T
    out, done = [], 0
    for i in first_longest(at, size).tolist():
        out += [text[done:at[i]], replacement]
        done = at[i] + size[i]
    return "".join([*out, text[done:]])


def replaced(texts: Bytes, at: np.ndarray, size: np.ndarray, replacement: bytes) -> pa.Array:
    """The texts with the bytes at ``at``, in order and apart, replaced."""
    times = np.ones(texts.size, np.int32)
    edge = np.zeros(texts.size + 1, np.int8)
    edge[at] += 1
    np.subtract.at(edge, at + size, 1)
    times[np.cumsum(edge[:-1]) > 0] = 0
    times[at] = len(replacement)
    upto = np.append(0, np.cumsum(times, dtype=np.int64))
    out = np.repeat(texts.data, times)
    for k, letter in enumerate(replacement):
        out[upto[at] + k] = letter
    return pa.Array.from_buffers(pa.large_string(), len(texts.borders) - 1, [None, pa.py_buffer(upto[texts.borders]), pa.py_buffer(out)])


def scrub(listed: Listed, texts: pa.Array, low: pa.Array, replacement: str) -> pa.Array:
    """Per text what the entries of the names in it show, and the text with the names replaced; nulls where none is."""
    given, lowered = Bytes(texts), Bytes(low)
    text, at, size, code = whole_words(listed, lowered)
    shown = listed.joined(text, code, len(texts), ", ")
    apart = unlike(given, lowered)
    plain = ~apart[text]
    at, size, code, text, own = at[plain], size[plain], code[plain], text[plain], (text[~plain], at[~plain], size[~plain])
    at = at - lowered.borders[text] + given.borders[text]
    kept = first_longest(at, size)
    done = replaced(given, at[kept], size[kept], replacement.encode()).cast(pa.string())
    if len(own[0]):
        values = done.to_pylist()
        for t in np.unique(own[0]).tolist():
            names = {lowered.data[a:a + s].tobytes().decode() for x, a, s in zip(*own) if x == t}
            values[t] = scrubbed_alone(texts[t].as_py(), sorted(names), replacement)
        done = pa.array(values, pa.string())
    return pa.StructArray.from_arrays([shown, pc.if_else(pc.is_valid(shown), done, pa.scalar(None, pa.string()))], ["listed", "text"])


def shown_in(df: DataFrame, table: pa.Table, low: Column, between: str) -> Column:
    """What the entries of the terms show that are substrings of ``low``, joined; null where none is."""
    shared = df.sparkSession.sparkContext.broadcast(Listed(table, False, False))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        listed = shared.value
        for batch in batches:
            for start, stop in stretches(batch):
                part = batch.slice(start, stop - start)
                texts = Bytes(part)
                text, code = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if listed.rest is not None:
                    text, _, _, code = listed.rest.found(texts)
                if len(listed.empty):
                    every = np.flatnonzero(part.is_valid().to_numpy(zero_copy_only=False))
                    text, code = np.concatenate([text, every]), np.concatenate([code, np.full(len(every), listed.empty[0])])
                yield listed.joined(text, code, len(part), between)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(low)


def scrubbed_in(df: DataFrame, table: pa.Table, text: Column, low: Column, replacement: str) -> Column:
    """``listed`` and ``text`` of ``scrub``, for whole words in any case."""
    shared = df.sparkSession.sparkContext.broadcast(Listed(table, True, True))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        listed = shared.value
        for texts, lowered in batches:
            for start, stop in stretches(texts):
                yield scrub(listed, *(readable(x.slice(start, stop - start)) for x in (texts, lowered)), replacement)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<listed:string,text:string>")(text, low)
