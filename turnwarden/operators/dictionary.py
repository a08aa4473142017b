"""Terms of a table found in texts, as an equi-join: one form for a handful of terms and for millions.

A term's key is its first ``PROBE`` characters, or all of a shorter one. A text gives the distinct grams of the key lengths that
occur, with as many further characters as the longest term needs; grams that cannot be a key never leave the row. A few keys
are written into the pattern that cuts the grams; of many keys the pattern holds the first characters, and a Bloom filter (one hash,
``BITS`` bits per key, at most ``MOST_BITS``) decides the rest. Its false hits, more of them the larger the table, cost a row each
and change nothing, because the join compares keys and then the whole term.

What is joined is (digest of the text, gram) on the hash of the key, and the whole term is compared; no text is shuffled for it or
part of a key. A table of at most ``SMALL`` characters is sent to the tasks, so its grams are looked up where they were cut. For
a larger one the grams are shuffled, once; a gram that stands in very many texts is a hot key of an inner join whose other side is
unique per term: adaptive execution splits it. What was found is gathered by digest, in each task first, and joins back as one
narrow row per text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden.functions.patterns import literal
from turnwarden.sources.shared import settle

PROBE = 8
#: Up to so many keys stand in the pattern itself; up to so many first characters narrow it.
IN_PATTERN, FIRST_CHARACTERS = 32, 512
BITS, MOST_BITS = 16, 1 << 23
#: Characters of the terms of a table that is sent to the tasks.
SMALL = 1 << 22

DIGEST = ["_h1", "_h2"]


def digest(text: Column) -> list[Column]:
    """128 bits that stand for a text, as two columns named ``DIGEST``."""
    return [F.xxhash64(text).alias(DIGEST[0]), F.xxhash64(F.lit("text"), text).alias(DIGEST[1])]


def _word(c: Column) -> Column:
    return c.rlike(r"(?U)^\w")


class Dictionary:
    """The rows of ``terms`` (a ``term`` and further columns), ready to be found in texts. Rows without a term are none; an empty
    term is in every text. ``at_words``: a term begins where a word does. ``whole_words``: it also ends where one ends."""

    def __init__(self, terms: DataFrame, at_words: bool = False, whole_words: bool = False):
        self.at_words, self.whole = at_words or whole_words, whole_words
        self.terms = settle(terms.filter("term is not null"), "terms").withColumn("_key", F.left("term", F.lit(PROBE)))
        keys = self.terms.groupBy("_key").agg(F.max(F.length("term")).alias("n"))
        size = self.terms.agg(F.sum(F.length("term") + 8).alias("n")).first()["n"] or 0
        self.small = size <= SMALL
        few = keys.limit(IN_PATTERN + 1).collect()
        self.filter = None
        if len(few) <= IN_PATTERN:
            self.sizes: dict[int, int] = {}
            for r in few:
                self.sizes[len(r["_key"])] = max(self.sizes.get(len(r["_key"]), 0), r["n"])
            heads = {k: [r["_key"] for r in few if len(r["_key"]) == k] for k in self.sizes}
        else:
            rows = keys.groupBy(F.length("_key").alias("k")).agg(
                F.max("n").alias("n"), F.count("*").alias("c"),
                F.slice(F.collect_set(F.left("_key", F.lit(1))), 1, FIRST_CHARACTERS + 1).alias("heads")).collect()
            self.sizes = {r["k"]: r["n"] for r in rows}
            heads = {r["k"]: r["heads"] if len(r["heads"]) <= FIRST_CHARACTERS else [] for r in rows}
            self._fit_filter(keys, sum(r["c"] for r in rows))
        self.patterns = {k: self._pattern(k, n, heads[k]) for k, n in self.sizes.items()}

    def _pattern(self, k: int, longest: int, heads: list[str]) -> str:
        """What cuts the grams that a key of length ``k`` may begin."""
        more = longest - k + (1 if self.whole else 0)
        start = r"(?sU)\b" if self.at_words else "(?s)"
        narrow = "" if not heads or k == 0 else "(?=%s)" % "|".join(literal(h) for h in sorted(heads))
        return f"{start}{narrow}(?=(.{{{k}}}" + (f".{{0,{more}}}" if more else "") + "))"

    def _fit_filter(self, keys: DataFrame, count: int) -> None:
        self.bits = min(MOST_BITS, max(1 << 12, 1 << (BITS * count - 1).bit_length()))
        place = F.pmod(F.xxhash64("_key"), F.lit(self.bits))
        words = keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(_key), {self.bits}) & 63 as int))").alias("b")) \
            .groupBy("w").agg(F.bit_or("b").alias("b")).collect()  # at most bits / 64 rows
        table = [0] * (self.bits // 64)
        for r in words:
            table[r["w"]] = r["b"]
        # A constant: it is parsed once per plan.
        self.filter = F.from_json(F.lit(json.dumps(table)), "array<bigint>")

    def _may(self, key: Column) -> Column:
        """Whether a key with this hash may be there."""
        place = F.pmod(key, F.lit(self.bits))
        bit = F.call_function("shiftright", F.get(self.filter, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int"))
        return bit.bitwiseAND(F.lit(1)) == 1

    @staticmethod
    def _gram(k: int):
        return lambda w: F.struct(F.xxhash64(F.left(w, F.lit(k))).alias("_key"), w.alias("_w"))

    def found(self, df: DataFrame, text: Column) -> DataFrame:
        """(``DIGEST``, columns of the terms) of the terms in the texts of ``df``. Copies of a text and places where its grams differ
        repeat rows: they are to be gathered by ``DIGEST`` with an aggregate that repeats do not change."""
        if not self.sizes:
            return self.terms.drop("_key").withColumns({n: F.lit(0).cast("long") for n in DIGEST}).limit(0)
        grams = []
        for k, pattern in self.patterns.items():
            cut = F.regexp_extract_all("_t", F.lit(pattern), F.lit(1)) if k else F.when(F.col("_t").isNotNull(), F.array(F.lit("")))
            grams.append(F.transform(F.array_distinct(cut), self._gram(k)))
        rows = df.select(text.alias("_t")).select(*digest(F.col("_t")), F.explode(F.concat(*[F.coalesce(g, F.array().cast(
            "array<struct<_key:bigint,_w:string>>")) for g in grams])).alias("_g")).select(*DIGEST, "_g.*")
        if self.filter is not None:
            rows = rows.filter(self._may(F.col("_key")))
        terms = self.terms.withColumn("_key", F.xxhash64("_key"))
        matched = rows.join(F.broadcast(terms) if self.small else terms, "_key").filter(F.startswith("_w", "term"))
        if self.whole:
            after = F.substring("_w", F.length("term") + 1, F.lit(1))
            matched = matched.filter((_word(after) != _word(F.right("term", F.lit(1)))) | (F.col("term") == ""))
        return matched.select(*DIGEST, *[c for c in self.terms.columns if c != "_key"])


def join_back(df: DataFrame, text: Column, found: DataFrame) -> DataFrame:
    """``df`` with the columns of ``found``, which has a row per ``DIGEST``; a text without a row gets nulls. Rows without a text
    match nothing and are dealt out by their place, or all of them would meet in one task."""
    first, second = digest(text)
    none = text.isNull()
    return df.withColumns({DIGEST[0]: F.when(none, F.monotonically_increasing_id()).otherwise(first),
                           DIGEST[1]: F.when(~none, second)}).join(found, DIGEST, "left").drop(*DIGEST)
