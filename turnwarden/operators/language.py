"""Language of a text from character trigrams, learned from a labelled table.

``fit`` counts all trigrams per language: a task counts its batches in arrays, so one row per language and trigram leaves a task
and not one per character. The model, a row per trigram seen, is written once as a table. Scoring reads it as a dense array that
is indexed by the number of a trigram and sums the weights of a text in the row: nothing is exploded, joined or shuffled. An alphabet
has only so many trigrams; a model of more than ``MOST_GRAMS`` is joined instead, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators.decisions import Step, record_all, start
from turnwarden.operators.dictionary import digest
from turnwarden.sources.shared import settle

SCALE = 10_000  # log-probabilities are kept as whole ten-thousandths, so sums do not depend on their order
#: Trigrams of a model that is sent to every task (8 bytes and 4 per language each), and slots of a dense index to them.
MOST_GRAMS, SLOTS = 1 << 21, 1 << 24
#: Bytes of text that are worked on at a time; arrays of over 100 bytes for each of them are needed then.
STRETCH = 1 << 17
#: Counts of trigrams that a task holds before it adds them up.
HELD = 1 << 18


class Weights:
    """The weights of a model, a row per trigram, found by the trigram's number."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.weights = codes[order], weights[order]
        letters = np.unique(np.concatenate([codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF])) if len(codes) else np.zeros(0, np.int64)
        self.size = len(letters) + 1
        self.number = np.zeros(0x110000, np.uint16 if self.size < 1 << 16 else np.uint32)  # of a letter; 0: in no trigram
        self.number[letters] = np.arange(1, self.size)
        self.dense = None
        if self.size ** 3 <= SLOTS:
            self.dense = np.full(self.size ** 3, -1, np.int32)
            self.dense[self.slot(self.codes >> 42, (self.codes >> 21) & 0x1FFFFF, self.codes & 0x1FFFFF)] = np.arange(len(codes))

    def slot(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        n = self.number
        return (n[a].astype(np.int64) * self.size + n[b]) * self.size + n[c]

    def find(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The row of each trigram, -1 for one that the model does not have."""
        if self.dense is not None:
            return self.dense[self.slot(a, b, c)]
        code = number_of(a, b, c)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, at, -1)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    grams: DataFrame  # code long (the trigram's number), w0 long, w1 long, ...
    shared: Broadcast | None = field(default=None, compare=False)


def letters(text: Column) -> Column:
    """The lower-cased letters, words separated by one blank."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit(" "))


def number_of(a, b, c):
    return (a.astype(np.int64) << 42) | (b.astype(np.int64) << 21) | c.astype(np.int64)


def trigram_numbers(text: Column) -> Column:
    """The numbers of the overlapping trigrams, as ``number_of`` gives them."""
    def letter(g: Column, k: int) -> Column:
        return F.ascii(F.substring(g, k, 1)).cast("long")

    grams = F.regexp_extract_all(letters(text), F.lit("(?s)(?=(.{3}))"), F.lit(1))
    return F.transform(grams, lambda g: F.shiftleft(letter(g, 1), 42).bitwiseOR(F.shiftleft(letter(g, 2), 21)).bitwiseOR(letter(g, 3)))


def batches_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Stretches of texts ``(from, to, characters, borders)``: their characters one after the other, and where each text begins."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + STRETCH, "right")) - 1)
        raw = bytes(memoryview(data)[offsets[start]:offsets[stop]]) if data is not None else b""
        first = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
        yield start, stop, np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32), first[offsets[start:stop + 1] - offsets[start]]
        start = stop


def trigrams_of(characters: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, ...]:
    """First, second and third letters of the trigrams within texts, and the text of each."""
    row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    inside = row[:-2] == row[2:] if len(row) > 2 else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    return characters[at], characters[at + 1], characters[at + 2], row[at]


def added_up(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several tables of trigrams and their counts as one."""
    found, at = np.unique(np.concatenate([c for c, _ in counts]), return_inverse=True)
    n = np.zeros(len(found), np.int64)
    np.add.at(n, at, np.concatenate([m for _, m in counts]))
    return found, n


def count_trigrams(labelled: DataFrame, text: str, language: str) -> DataFrame:
    """(lang, code, n), summed per task and then over all. A task hands on what it has counted early if that becomes too much to hold."""
    def rows_of(lang: str, found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(found), np.int32))), pa.array(found), pa.array(n)], ["lang", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = {}, 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names, of = langs.dictionary, langs.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for start, stop, characters, borders in batches_of(batch.column(1)):
                a, b, c, row = trigrams_of(characters, borders)
                code, lang = number_of(a, b, c), of[start:stop][row]
                for k in np.unique(lang[lang >= 0]):
                    found = np.unique(code[lang == k], return_counts=True)
                    counts.setdefault(names[int(k)].as_py(), []).append(found)
                    held += len(found[0])
                if held > HELD:
                    counts = {name: [added_up(some)] for name, some in counts.items()}
                    held = sum(len(some[0][0]) for some in counts.values())
                    if held > HELD // 2:
                        yield from (rows_of(name, *some[0]) for name, some in counts.items())
                        counts, held = {}, 0
        yield from (rows_of(name, *added_up(some)) for name, some in counts.items())

    rows = labelled.select(F.col(language).alias("lang"), letters(F.col(text)).alias("text")).mapInArrow(run, "lang string, code long, n long")
    return rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, text: str = "text", language: str = "lang") -> LanguageModel:
    """Counts of all trigrams seen, smoothed over the trigrams seen in any language. Rows without a label are not counted."""
    profile = settle(count_trigrams(labelled, text, language), "language-profile")
    different = profile.select("code").distinct().count()
    known = {r["lang"]: r["total"] for r in profile.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    languages = tuple(sorted(known))
    weights = {}
    for i, lang in enumerate(languages):
        n = F.coalesce(F.max(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0))
        share = (n + 0.5) / F.lit(known[lang] + 0.5 * different)
        weights[f"w{i}"] = F.round(F.log(share) * SCALE).cast("long")
    if not languages:
        return LanguageModel((), profile.select("code"))
    return loaded(languages, settle(profile.groupBy("code").agg(*[w.alias(name) for name, w in weights.items()]), "language-model"), different)


def loaded(languages: Sequence[str], grams: DataFrame, count: int | None = None) -> LanguageModel:
    """A model from its written table; its weights are sent to the tasks if they are few enough."""
    count = grams.count() if count is None else count
    shared = None
    if count <= MOST_GRAMS:
        table = grams.toArrow()
        weights = np.stack([table.column(f"w{i}").to_numpy() for i in range(len(languages))], axis=1).astype(np.int32)
        shared = grams.sparkSession.sparkContext.broadcast((table.column("code").to_numpy(), weights))
    return LanguageModel(tuple(languages), grams, shared)


_WEIGHTS: list = []


def _weights(shared: Broadcast) -> Weights:
    """The worker's index of a model; it is kept with the value that it was made from."""
    value = shared.value
    if not _WEIGHTS or _WEIGHTS[0] is not value:
        _WEIGHTS[:] = [value, Weights(*value)]
    return _WEIGHTS[1]


def weight_sums(model: LanguageModel, text: Column, once: bool = False) -> Column:
    """The summed weights of a text per language, in the row; NULL for a text without a known trigram. ``once`` keeps the optimizer
    from computing them again below a filter on them, at the price that no filter moves below them."""
    shared, n = model.shared, len(model.languages)

    @F.arrow_udf("array<bigint>")
    def sums(texts: pa.Array) -> pa.Array:
        w, out, known = _weights(shared), [np.zeros((0, n), np.int64)], [np.zeros(0, bool)]
        for start, stop, characters, borders in batches_of(texts):
            *gram, row = trigrams_of(characters, borders)
            at = w.find(*gram)
            row, at = row[at >= 0], at[at >= 0]
            upto = np.concatenate([np.zeros((1, n), np.int64), np.cumsum(w.weights[at], axis=0, dtype=np.int64)])
            ends = np.searchsorted(row, np.arange(stop - start + 1))
            out.append(upto[ends[1:]] - upto[ends[:-1]])
            known.append(ends[1:] > ends[:-1])
        every, has = np.concatenate(out), np.concatenate(known)
        offsets = pa.array(np.arange(len(has) + 1) * n, pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(every.ravel()), mask=pa.array(~has))

    return (sums.asNondeterministic() if once else sums)(letters(text))


def most_likely(model: LanguageModel, sums: Column) -> tuple[Column, Column]:
    """Language and probability from the summed weights."""
    best = F.array_max(sums)
    odds = sum((F.exp((F.get(sums, F.lit(i)) - best) / SCALE) for i in range(len(model.languages))), F.lit(0.0))
    language = F.get(F.array(*map(F.lit, model.languages)), (F.array_position(sums, best) - 1).cast("int"))
    return language, F.lit(1.0) / odds


def score(df: DataFrame, model: LanguageModel, key: str, text: Column) -> DataFrame:
    """(key, language, probability) of the most likely language; texts without a known trigram have no row."""
    if not model.languages:
        return df.select(key, F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability")).limit(0)
    if model.shared is not None:
        summed = df.select(key, weight_sums(model, text, once=True).alias("_sums"))
    else:
        names = [f"w{i}" for i in range(len(model.languages))]
        summed = (df.select(key, F.explode(trigram_numbers(text)).alias("code")).join(model.grams, "code")
                  .groupBy(key).agg(F.array(*[F.sum(n) for n in names]).alias("_sums")))
    language, probability = most_likely(model, F.col("_sums"))
    return summed.filter("_sums is not null").select(key, language.alias("language"), probability.alias("probability"))


def with_language(df: DataFrame, model: LanguageModel, text: Column) -> DataFrame:
    """``df`` with ``_language`` and ``_p`` where ``text`` is not null: in the row, or by a join for a model of too many trigrams."""
    if model.shared is None:
        named = F.concat_ws("/", *digest(text))
        texts = df.select(F.when(text.isNotNull(), named).alias("_text"), text.alias("_t")).filter("_t is not null").dropDuplicates(["_text"])
        return join_scores(df.withColumn("_text", F.when(text.isNotNull(), named)), score(texts, model, "_text", F.col("_t")), "_text").drop("_text")
    language, probability = most_likely(model, F.col("_sums"))
    return df.withColumn("_sums", weight_sums(model, text)).withColumns({"_language": language, "_p": probability}).drop("_sums")


def join_scores(df: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    found = scores.select(key, F.col("language").alias("_language"), F.col("probability").alias("_p"))
    return df.join(found, key, "left")


def language_steps(text: Column, allowed: Sequence[str] = tuple(fixed.ALLOWED_LANGUAGES),
                   min_chars: int = fixed.LANGUAGE_MIN_CHARS,
                   min_confidence: float = fixed.LANGUAGE_MIN_CONFIDENCE) -> list[Step]:
    """Reads ``_language`` and ``_p``."""
    foreign = (F.length(text) >= min_chars) & ~F.col("_language").isin(list(allowed)) & (F.col("_p") >= min_confidence)
    detail = F.concat(F.lit("detected '"), F.col("_language"), F.lit("' ("), F.format_string("%.2f", "_p"), F.lit(")"))
    return [Step(21, "Language restriction", "blocked", F.when(foreign, detail))]


def language_screen(df: DataFrame, scores: DataFrame, allowed: Sequence[str] = tuple(fixed.ALLOWED_LANGUAGES),
                    min_chars: int = fixed.LANGUAGE_MIN_CHARS,
                    min_confidence: float = fixed.LANGUAGE_MIN_CONFIDENCE,
                    key: str = "turn_id", text: str = "text") -> DataFrame:
    """Block texts that are long enough and confidently in another language. Without a score the text passes."""
    df = join_scores(start(df), scores, key)
    return record_all(df, language_steps(F.col(text), allowed, min_chars, min_confidence)).drop("_language", "_p")
