"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, grouping by union-find.

1. The distinct two-word shingles of a text are hashed. In a signature of ``SLOTS`` places every shingle has a random rank
   order of the places; its value in a place is the rank plus a fraction, and the place keeps the least value. The ranks of one
   shingle are a permutation, so places of a signature are spread more evenly than by independent hashes. Ranks are dealt out
   for all shingles of a text at a time, rank 0 first; once every place has a value the text is done, since later ranks are
   larger. The permutation is rank -> a * rank + b modulo the prime ``SLOTS``, with a and b from the shingle's hash: any two
   places get any two ranks with the probability of a uniform permutation.
2. Texts of equal sets form a class, of which the smallest id takes part. Every ``ROWS`` places are a band; equal bands make a
   bucket. A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^31 < 1e-7.
3. In a bucket, every class meets one pivot, the one of the smallest id, so a bucket of any size makes a linear number of pairs.
   Of its pivots a class is first compared with the smallest alone, which connects most groups; the other pairs follow only where
   their classes are not connected by then. Pairs are confirmed on their full sets. What stays open is compared with further pivots,
   and in the end all of it with each other, so that no link between unconnected classes is left out.
4. Links are contracted to stars (large star, small star) until nothing changes; rounds are written to the shared folder.

Classes are named by the least id of their rows, nulls last, and 128 bits of their set: four numbers, so that what is shuffled per
band stays narrow. Sets are computed where the texts are read, of those documents alone that a filter lets through, and never
shuffled with the texts. Rows of null ids and rows that share an id take part as documents of their own.

Defined results: a text without words has an empty set and is linked with nothing; one word is a set of one; a component without
any id is named null; of equal rows of one id at most one is kept; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden.llm.pieces import stretches
from turnwarden.llm.text import BITS, bit_place, bit_words, forgotten, parted, released
from turnwarden.sources.shared import settle

SLOTS, ROWS = 127, 4
BANDS = SLOTS // ROWS
#: Least similarity in per cent.
SIMILAR = 80
#: Rounds with a further pivot per bucket, before all pairs that are left and can be alike are compared.
PIVOTS = 1
#: The type of ``row_key``.
KEY = "struct<none: boolean, id: bigint, h1: bigint, h2: bigint>"

_FREE = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the shingles of each text, text after text, and how many each text has. Bytes split at just
    the six characters that separate words, and only A-Z change case. A text of fewer words is one shingle."""
    words = [t.lower().split() if t else [] for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws), np.uint64, int(counts.sum()))
    doc = np.repeat(np.arange(len(words)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(doc))  # words up to the end of the text
    value = np.zeros(len(doc), np.uint64)
    for k in range(size):
        inside = np.flatnonzero(left > k)
        inside = inside if k < len(doc) else inside[:0]
        value[inside] = mix(value[inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[inside + k] + np.uint64(k + 1))
    starts = (left >= size) | (np.repeat(counts, counts) == left)
    value, doc = value[starts], doc[starts]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[fresh], np.bincount(doc[fresh], minlength=len(words))


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of ``SLOTS`` least values per text; texts without shingles keep ``_FREE``."""
    out = np.full(len(counts) * SLOTS, _FREE)
    doc = np.repeat(np.arange(len(counts)), counts)
    a = mix(values ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(SLOTS - 1) + np.uint64(1)
    b = mix(values ^ np.uint64(0x14057B7EF767814F)) % np.uint64(SLOTS)
    for rank in range(SLOTS):
        slot = ((a * np.uint64(rank) + b) % np.uint64(SLOTS)).astype(np.int64)
        fraction = mix(values + np.uint64((rank + 1) * 0xD1342543DE82EF95 % 2**64)) >> np.uint64(24)
        np.minimum.at(out, doc * SLOTS + slot, (np.uint64(rank) << np.uint64(40)) | fraction)
        open_ = (out.reshape(-1, SLOTS) == _FREE).any(axis=1)[doc]
        if not open_.any():
            break
        values, doc, a, b = values[open_], doc[open_], a[open_], b[open_]
    return out.reshape(-1, SLOTS)


def bands(signature: np.ndarray) -> np.ndarray:
    """A key per band and text, different between bands."""
    parts = signature[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(parts), 1))
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart, but for rows of equal id and text; ordered by id, nulls last. No field is null."""
    number = doc_id.cast("long")
    return F.struct(number.isNull().alias("none"), F.coalesce(number, F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("h1"),
                    F.xxhash64(F.lit(1), text).alias("h2"))


#: What names a class: the least id of its rows (the largest number if all are null), its set's 128 bits and size.
NODE = ["o", "d1", "d2", "n"]


def sketch(docs: DataFrame, size: int, chosen: Broadcast | None = None, with_sets: bool = False) -> DataFrame:
    """Per row of ``docs`` (row, text): row, d1 and d2 (128 bits of the set), n, and the band keys, or else the set itself. With
    ``chosen``, a bit map over hashes of ``row``, only of rows that it has (or seems to have)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if chosen is None else np.frombuffer(chosen.value, np.uint64)
        for batch in batches:
            if bits is not None:
                place = batch.column(2).to_numpy()
                batch = batch.filter(pa.array((bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1))
            rows, texts = batch.column(0), batch.column(1).to_pylist()
            for start, end in stretches(texts):
                values, counts = shingle_sets(texts[start:end], size)
                ends = np.concatenate([[0], np.cumsum(counts)])
                own = rows.slice(start, end - start)
                digests = b"".join(hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends, ends[1:]))
                halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
                if with_sets:
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))
                else:
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(end - start + 1) * BANDS, pa.int32()),
                                                     pa.array(bands(signatures(values, counts)).ravel()))
                yield pa.RecordBatch.from_arrays([own, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(counts, pa.int64()), lists],
                                                 ["row", "d1", "d2", "n", "list"])

    return docs.select("row", F.col("text").cast("binary").alias("text"), bit_place("row").alias("place")).mapInArrow(run, f"row {KEY}, d1 long, d2 long, n long, list array<long>")


def sets_of(docs: DataFrame, classes: DataFrame, ends: DataFrame, size: int) -> DataFrame:
    """``d1, d2, list``: the full sets of the classes ``ends`` (d1, d2), from the texts of their representatives. Of equal rows one
    is kept."""
    asked = released(classes.join(ends.distinct(), ["d1", "d2"]).select("d1", "d2", "rep"), "minhash-ends")
    words = bit_words(asked, "rep")
    if words is None:
        found = sketch(docs.join(asked.select(F.col("rep").alias("row")), "row", "left_semi"), size, None, True)
    else:
        words = words.toArrow()
        bits = np.zeros(BITS // 64, np.int64)
        bits[words.column("_w").to_numpy()] = words.column("_b").to_numpy()
        found = sketch(docs, size, docs.sparkSession.sparkContext.broadcast(bits.tobytes()), True)
    return found.join(asked, ["d1", "d2"]).filter("row = rep").groupBy("d1", "d2").agg(F.first("list").alias("list"))


def verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Of ``pairs`` of classes a and b, those alike enough, as ``u`` and ``v``."""
    def side(x: str) -> DataFrame:
        return sets.select(F.col("d1").alias(f"{x}1"), F.col("d2").alias(f"{x}2"), F.col("list").alias(f"set_{x}"))

    ends = [F.col(f"{x}.d{k}").alias(f"{x}{k}") for x in "ab" for k in (1, 2)]
    both = pairs.select("a", "b", *ends).join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"])
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return released(both.filter(shared * 100 >= (F.col("a.n") + F.col("b.n") - shared) * similar).select(
        F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "minhash-links")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest key reachable, for all keys in ``links`` (u, v) that are not smallest themselves.

    Each round joins every key to the smallest of its neighbours. The links are done when they are stars: every key has one link,
    and none links to a key that has one itself.
    """
    links = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    while True:
        ways = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        links = settle(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lower.select("u", F.col("m").alias("v"))).distinct(), "components")
        ends = links.select(F.col("u").alias("id"), F.lit(1).alias("n")).unionByName(links.select(F.col("v").alias("id"), F.lit(0).alias("n")).distinct())
        if ends.groupBy("id").agg(F.sum("n").alias("n"), F.min("n").alias("v")).filter("n > 1 or (n = 1 and v = 0)").isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))


def close_pairs(df: DataFrame, similar: int) -> DataFrame:
    """Without pairs whose sizes alone rule the similarity out."""
    low, high = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    return df.filter(low * 100 >= high * similar)


def labelled(df: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the component of the class in ``column``; a class without links is its own."""
    of = labels.select(F.col("node").alias(column), F.col("component").alias(name))
    return df.join(of, column, "left").withColumn(name, F.coalesce(name, column))


def still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component, with the component as ``label``."""
    marked = labelled(members, labels, "a", "label").select("key", "a", "label")
    mixed = marked.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    return released(marked.join(mixed, "key"), "minhash-open")


def grouped(docs: DataFrame, doc_id: str, text: str, size: int, similar: int) -> tuple[DataFrame, list[DataFrame]]:
    """Per key of rows of ``docs``: ``row``, the key; n; ``component``, the key of the group's representative, or null for an empty
    set; and how many rows have the key (c). Then the large tables that this is read from."""
    docs = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text"))
    rows = settle(sketch(docs, size), "minhash-sketch")
    classes = rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("rep"), F.first("n").alias("n"), F.first("list").alias("keys"))
    order = F.when(F.col("rep.none"), F.lit(2**63 - 1)).otherwise(F.col("rep.id"))
    classes = released(classes.withColumns({"o": order, "no": F.monotonically_increasing_id()}), "minhash-classes")
    entries = classes.select(F.explode("keys").alias("key"), "no")
    # Most keys stand alone: they are counted first, and only entries of the others are kept and get their class.
    busy = released(entries.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "minhash-keys")
    members = released(entries.join(busy, "key").join(classes.select("no", F.struct(*NODE).alias("a")), "no").select("key", "a", "c"), "minhash-buckets")
    pivots = members.groupBy("key").agg(F.min("a").alias("b"))
    pairs = released(close_pairs(members.join(pivots, "key").filter("a <> b").select("a", "b").distinct(), similar), "minhash-pairs")
    sets = sets_of(docs, classes, pairs.select("a.d1", "a.d2").union(pairs.select("b.d1", "b.d2")), size)
    first = pairs.groupBy("a").agg(F.min("b").alias("b"))
    labels = components(verified(first, sets, similar))
    others = labelled(labelled(pairs.join(first, ["a", "b"], "left_anti"), labels, "a", "x"), labels, "b", "y").filter("x <> y").select("a", "b")
    more = verified(others, sets, similar)
    if not more.isEmpty():
        labels = components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))
    # A bucket of two has no pair that its pivot has not seen.
    left, sets = still_open(members.filter("c > 2"), labels), None
    for turn in range(PIVOTS + 1):
        if left.isEmpty():
            break
        if sets is None:
            sets = sets_of(docs, classes, left.select("a.d1", "a.d2"), size)
        if turn < PIVOTS:
            # Another pivot in every bucket, so a class meets as many of a group as it has buckets with it.
            order = F.struct(F.xxhash64(F.lit(turn), "key", "a.d1").alias("h"), "a", "label")
            turned = left.groupBy("key").agg(F.min(order).alias("p")).select("key", F.col("p.a").alias("b"), F.col("p.label").alias("other"))
            more = left.join(turned, "key").filter("label <> other").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        else:
            more = unconnected(left, sets, similar)
        new = verified(close_pairs(more.distinct(), similar), sets, similar)
        if not new.isEmpty():
            labels = components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(new))
        if turn < PIVOTS:
            left = still_open(left.select("key", "a"), labels)
    forgotten(busy, members, pairs)
    named = classes.select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.col("rep").alias("component"))
    of = labels.select("node.d1", "node.d2", F.col("component.d1").alias("c1"), F.col("component.d2").alias("c2")).join(named, ["c1", "c2"])
    of = classes.select("d1", "d2", "rep").join(of, ["d1", "d2"], "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    full, empty = rows.filter("n > 0").select("row", "n", "d1", "d2"), rows.filter("n = 0").select("row", "n")
    return full.join(of, ["d1", "d2"]).select("row", "n", "component").unionByName(empty, allowMissingColumns=True).groupBy(
        "row", "n", "component").agg(F.count("*").alias("c")), [rows, classes]


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2, similar: int = SIMILAR) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept. A group keeps one row."""
    def number(key: str) -> Column:
        return F.when(~F.col(f"{key}.none"), F.col(f"{key}.id"))

    of = grouped(docs, doc_id, text, size, similar)[0].withColumn("tie", F.explode(F.sequence(F.lit(1).cast("long"), F.col("c"))))
    return of.select(
        number("row").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, number("component")).otherwise(number("row")).alias("component_id"),
        ((F.col("n") == 0) | ((F.col("row") == F.col("component")) & (F.col("tie") == 1))).alias("kept"))


def unconnected(left: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Every pair of open classes of different components that can be alike, exactly.

    Two sets of n and m elements that are alike enough share one of the n - ceil(similar n) + 1 elements of the first and of as
    many of the second, if both list their elements in the same order (prefix filter). Rare elements come first, so texts that
    have a common passage but else go their own ways do not meet. Elements meet without the lists that they stand in; pairs for
    which what both list from there on can be enough are weighed once more by the two prefixes.
    """
    of = left.select("a", "label").distinct().withColumns({"d1": F.col("a.d1"), "d2": F.col("a.d2")})
    texts = of.join(sets, ["d1", "d2"]).select("a", "label", F.explode("list").alias("token"))
    counts = released(texts.groupBy("token").agg(F.count("*").alias("f")).filter("f > 1"), "minhash-tokens")
    listed = texts.join(counts, "token").groupBy("a", "label").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("t"))
    # Elements that no other set has are at the head of the list; they use up places of the prefix.
    alone = F.col("a.n") - F.size("t")
    room = F.col("a.n") - F.ceil(F.col("a.n") * similar / 100) + 1 - alone
    prefix = released(listed.filter(room > 0).select(
        "a", "label", alone.alias("alone"), F.transform(F.slice("t", F.lit(1), room.cast("int")), lambda x: x["token"]).alias("ts")), "minhash-prefixes")
    # What a set lists from this element on. The lists stay behind: rows of one element hold nothing that grows with them.
    rows = prefix.select(F.posexplode("ts").alias("at", "token"), "a.d1", "a.d2", "a.n", F.col("label.d1").alias("l1"), F.col("label.d2").alias("l2"),
                         (F.col("a.n") - F.col("alone")).alias("rest")).withColumn("rest", F.col("rest") - F.col("at")).drop("at")
    x, y = rows.alias("x"), rows.alias("y")
    can_be = (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * similar) & (
        F.least("x.rest", "y.rest") * (100 + similar) >= (F.col("x.n") + F.col("y.n")) * similar)
    once = (F.col("x.d1") < F.col("y.d1")) | ((F.col("x.d1") == F.col("y.d1")) & (F.col("x.d2") < F.col("y.d2")))
    apart = (F.col("x.l1") != F.col("y.l1")) | (F.col("x.l2") != F.col("y.l2"))
    ends = [F.col(f"{side}.d{k}").alias(f"{name}{k}") for side, name in (("x", "a"), ("y", "b")) for k in (1, 2)]
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & once & apart & can_be).select(*ends).distinct()

    def side(name: str) -> DataFrame:
        return prefix.select(F.col("a.d1").alias(f"{name}1"), F.col("a.d2").alias(f"{name}2"), F.col("a").alias(name), F.col("alone").alias(f"alone_{name}"),
                             F.col("ts").alias(f"ts_{name}"))

    # Of what both lists have, nothing before the last element that both prefixes have is missed by the prefixes.
    common = F.array_intersect("ts_a", "ts_b")
    last = F.element_at(common, -1)
    rest = F.least(*[F.col(f"{name}.n") - F.col(f"alone_{name}") - F.array_position(f"ts_{name}", last) + 1 for name in "ab"])
    enough = (F.size(common) - 1 + rest) * (100 + similar) >= (F.col("a.n") + F.col("b.n")) * similar
    return met.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"]).filter(enough).select("a", "b")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 2, similar: int = SIMILAR) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id. Only the keys of rows that go are joined, and only to
    rows that may be these; all others are handed on where they are read."""
    of, made = grouped(docs, doc_id, text, size, similar)
    of = of.filter("n > 0 and (row <> component or c > 1)")
    gone = released(of.select(F.col("row").alias("_row"), (F.col("row") == F.col("component")).alias("_one")), "minhash-gone")
    forgotten(*made)
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), row_key(F.col(doc_id), F.col(text)).alias("_row"))
    packed, others = parted(packed, gone, "_row")
    # Of rows equal in id and text one stays, the least by its other columns.
    one = packed.join(gone.filter("_one").select("_row"), "_row", "left_semi").groupBy("_row").agg(F.min("_doc").alias("_doc"))
    return others.select("_doc.*").unionByName(packed.join(gone, "_row", "left_anti").select("_doc.*")).unionByName(one.select("_doc.*"))
