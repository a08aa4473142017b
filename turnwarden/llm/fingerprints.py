"""Fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a bag of words, a word's weight its count. For each sample and word a hash gives r and c, both Gamma(2, 1), and
beta, uniform. With t = floor(ln(weight) / r + beta) the word competes with ln a = ln c - r (t - beta + 1), and the least value
of the text is the sample. Equal least values mean the same word and the same t, so two texts agree in a sample with the
probability of their generalised Jaccard similarity (sum of smaller over sum of larger weights).

Documents are compared with the next one in descending id. For this they are dealt once into buckets of neighbouring ids, and
everything up to the fingerprint happens where the bucket lies; the last row of a bucket takes its neighbour from a table of
the buckets' first rows. Buckets come from ``QUANTILES`` quantiles of the ids, divided evenly between two of them.

Defined results: a null text is empty; a text without words has the empty fingerprint, like itself (1) and unlike any other
(0); null ids come last and are ordered by a hash of the text, as are rows of one id; a single row is its own next document;
other columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnwarden.llm.text import numbered, words
from turnwarden.sources.shared import settle

SAMPLES = 64
#: Samples that one row computes; divides ``SAMPLES``.
ABREAST = 4
#: Quantiles of the ids that are taken, and rows that a bucket holds on average.
QUANTILES, ROWS = 256, 2000


def term_weights(df: DataFrame, text: str, kept: list[str]) -> DataFrame:
    """``kept`` and a row per distinct word of ``text``: ``_term``, a hash of it, and ``_weight``, its count. A text without
    words has one row with nulls."""
    step = df.select(*kept, F.sort_array(F.transform(words(F.col(text)), lambda w: F.xxhash64(w))).alias("_s"))
    first = F.filter(F.when(F.size("_s") > 0, F.sequence(F.lit(0), F.size("_s") - 1)),
                     lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    step = step.select(*kept, "_s", first.alias("_b"))
    terms = F.transform("_b", lambda b, k: F.struct(
        F.get("_s", b).alias("h"), (F.coalesce(F.get("_b", k + 1), F.size("_s")) - b).alias("w")))
    return step.select(*kept, F.explode_outer(terms).alias("_t")).select(
        *kept, F.col("_t.h").alias("_term"), F.log(F.col("_t.w")).alias("_ln_weight"))


def gamma_quantile(p: float) -> float:
    """The value that Gamma(2, 1) stays below with probability p."""
    low, high = 0.0, 60.0
    for _ in range(80):
        x = (low + high) / 2
        low, high = (x, high) if 1 - (1 + x) * math.exp(-x) < p else (low, x)
    return (low + high) / 2


#: Quantiles of Gamma(2, 1) at k / BINS. Between two of them values are interpolated, beyond the outermost they are computed.
BINS = 512
QUANTILES_R = [gamma_quantile(k / BINS) for k in range(BINS)]
QUANTILES_C = [0.0] + [math.log(q) for q in QUANTILES_R[1:]] + [math.log(gamma_quantile(1 - 1e-6))]


def sample(number: Column) -> Column:
    """ln a of the row's term for a sample. One hash of 64 bits gives 21 bits for r, 22 for ln c and 21 for beta."""
    x = F.xxhash64("_term", number)

    def between(table: list[float], bits: Column, width: int) -> Column:
        at, step = F.shiftright(bits, width - 9).cast("int"), 2.0 ** (9 - width)
        values = F.array(*map(F.lit, table))
        low = F.get(values, at)
        return low + (F.get(values, at + 1) - low) * ((bits.bitwiseAND(2 ** (width - 9) - 1) + 0.5) * step)

    first, second = F.shiftrightunsigned(x, 43), F.shiftrightunsigned(x, 21).bitwiseAND(2**22 - 1)
    # The last bin of r is open above: 1 - p = (1 + r) e^-r, solved to the second order. The first of c is open below: p = c^2 / 2.
    rest = -F.log((F.lit(2.0**21 - 0.5) - first) * 2.0**-21)
    r = F.when(first >= 2**21 - 2**12, rest + F.log(1 + rest + F.log(1 + rest))).otherwise(between(QUANTILES_R, first, 21))
    ln_c = F.when(second < 2**13, 0.5 * F.log((second + 0.5) * 2.0**-21)).otherwise(between(QUANTILES_C, second, 22))
    beta = x.bitwiseAND(2**21 - 1) * 2.0**-21
    t = F.floor(F.col("_ln_weight") / r + beta)
    return ln_c - r * (t - beta + 1)


def signatures(df: DataFrame, text: str, key: list[str]) -> DataFrame:
    """``key`` (which must tell rows apart) and ``signature``: an int per sample, an empty array for a text without words.

    Where ``df`` is dealt out by a part of ``key``, nothing is shuffled; elsewhere words are summed up before.
    """
    terms = term_weights(df, text, key)
    # A row per word and ABREAST samples: generated code for more at once grows too large to be compiled, and a row per sample
    # looks its group up that many times more often.
    firsts = F.array(*map(F.lit, range(0, SAMPLES, ABREAST)))
    names = [f"_least{k}" for k in range(ABREAST)]
    values = terms.withColumn("_sample", F.explode(firsts)).select(
        *key, "_sample", *[sample(F.col("_sample") + k).alias(name) for k, name in enumerate(names)])
    least = values.groupBy(*key, "_sample").agg(*[F.min(name).alias(name) for name in names])
    part = F.struct("_sample", F.array(*[F.hash(name) for name in names]).alias("s"))
    parts = F.sort_array(F.collect_list(F.when(F.col(names[0]).isNotNull(), part)))
    return least.groupBy(*key).agg(F.flatten(F.transform(parts, lambda p: p["s"])).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """The share of samples that agree; two empty signatures agree."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(
        (F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(same / F.lit(float(SAMPLES)))


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits per sample."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def in_buckets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``_id``, ``_text``, ``_tie`` and ``_bucket``, a number that falls with the id; bucket numbers below 256 hold null ids."""
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    total = docs.count()
    cuts = sorted(set(docs.select(F.col(doc_id).cast("double").alias("x")).approxQuantile("x", [i / QUANTILES for i in range(QUANTILES + 1)], 1e-3))) or [0.0]
    per = max(1, round(total / QUANTILES / ROWS))
    lows = F.array(*map(F.lit, cuts))
    place = F.greatest(F.size(F.filter(lows, lambda c: c <= F.col("_id"))), F.lit(1))
    rows = rows.withColumn("_place", place)
    low, high = F.get(lows, F.col("_place") - 1), F.coalesce(F.get(lows, F.col("_place")), F.get(lows, F.col("_place") - 1) + 1)
    within = F.greatest(F.lit(0), F.least(F.lit(per - 1), F.floor((F.col("_id") - low) / (high - low) * per)))
    bucket = F.when(F.col("_id").isNull(), F.shiftrightunsigned("_tie", 56)).otherwise(F.col("_place") * F.lit(per) + within + 256)
    return rows.select("_id", "_text", "_tie", bucket.cast("long").alias("_bucket"))


def with_next(rows: DataFrame, order: list[Column], column: str, name: str, following: DataFrame) -> DataFrame:
    """``rows`` with ``name``: ``column`` of the next row in ``order``, buckets descending, after the last the first."""
    window = Window.partitionBy("_bucket").orderBy(*order)
    led = rows.withColumns({"_n": F.row_number().over(window), "_lead": F.lead(F.struct(column)).over(window)})
    firsts = rows.withColumn("_f", F.row_number().over(window)).filter("_f = 1").select(F.col("_bucket").alias("_after"), F.struct(column).alias("_head"))
    heads = following.join(firsts, "_after").select("_bucket", "_head")
    return led.join(heads, "_bucket", "left").withColumn(name, F.coalesce("_lead", "_head")[column]).drop("_lead", "_head")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited text is the
    document's with the second half of its characters replaced by as many of the next one's first."""
    rows = in_buckets(docs, doc_id, text)
    order = [F.desc_nulls_last("_id"), F.asc("_tie")]
    buckets = numbered(rows.select("_bucket").distinct(), [F.desc("_bucket")], "_b", "fingerprint-buckets")
    buckets = settle(buckets, "fingerprint-buckets")
    count = F.lit(buckets.count())
    following = buckets.select("_bucket", ((F.col("_b") + 1) % count).alias("_b")).join(
        buckets.select("_b", F.col("_bucket").alias("_after")), "_b").select("_bucket", "_after")
    paired = with_next(rows, order, "_text", "_next", following)
    half = F.floor(F.length("_text") / 2).cast("int")
    edited = F.concat(F.substr("_text", F.lit(1), F.length("_text") - half), F.substr("_next", F.lit(1), half))
    both = paired.select("_bucket", "_n", "_id", F.length("_text").cast("long").alias("_chars"), "_text", edited.alias("_edited"))
    both = both.select("_bucket", "_n", "_id", "_chars", F.unhex(F.sha2("_edited", 256)).alias("_sha"),
                       F.posexplode(F.array("_text", "_edited")).alias("_kind", "_one"))
    signed = signatures(both, "_one", ["_bucket", "_n", "_id", "_chars", "_sha", "_kind"])
    pair = F.sort_array(F.collect_list(F.struct("_kind", "signature")))
    signed = signed.groupBy("_bucket", "_n", "_id", "_chars", "_sha").agg(pair.alias("_pair")).select(
        "_bucket", F.col("_n").alias("_row"), "_id", "_chars", "_sha", F.get("_pair", F.lit(0))["signature"].alias("_own"),
        F.get("_pair", F.lit(1))["signature"].alias("_other"))
    signed = settle(signed, "fingerprints")
    out = with_next(signed, [F.asc("_row")], "_own", "_next_own", following)
    return out.select(
        F.col("_id").alias("doc_id"), F.col("_chars").alias("n_chars"), F.lower(F.hex("_sha")).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_other")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"), likeness(F.col("_own"), F.col("_next_own")).alias("near_next"))
