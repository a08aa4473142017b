"""How the rules relate to each other and to labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnwarden.operators.decisions import start


def independent_blocks(df: DataFrame, rules: Mapping[int, Callable[[DataFrame], DataFrame]],
                       text: str = "text") -> DataFrame:
    """Add ``fired``: the numbers of all rules that would block the row, each judged on the text as it came.

    ``rules`` is ordered as in the stack, so the first entry is the rule that would be reported.
    """
    clean = df.withColumn("_raw", F.col(text))
    for number, rule in rules.items():
        clean = rule(start(clean)).withColumn(f"_b{number}", F.col("blocked_by").isNotNull()) \
            .withColumn(text, F.col("_raw")).drop("decisions", "blocked_by")
    fired = F.array_compact(F.array(*[F.when(F.col(f"_b{n}"), F.lit(n)) for n in rules]))
    return clean.withColumn("fired", fired).drop("_raw", *[f"_b{n}" for n in rules])


def cofiring(fired: DataFrame) -> DataFrame:
    """(rule, other, n): rows on which two rules both fire; ``rule = other`` counts the rule itself.

    Pairs are made inside a row, of which each holds at most as many rules as the stack, and summed before the shuffle.
    """
    return (fired.filter(F.size("fired") > 0)
            .select("fired", F.explode("fired").alias("rule"))
            .select("rule", F.explode("fired").alias("other"))
            .groupBy("rule", "other").agg(F.count("*").alias("n")))


def first_blocker_share(fired: DataFrame, rules: Sequence[int]) -> DataFrame:
    """(rule, fires, first, unreachable): how often a rule fires, how often it is the one reported, and whether an
    earlier rule always beats it."""
    counts = (fired.select(F.posexplode("fired").alias("p", "rule"))
              .groupBy("rule").agg(F.count("*").alias("fires"), F.count_if(F.col("p") == 0).alias("first")))
    spine = fired.sparkSession.createDataFrame([(n,) for n in rules], "rule int")
    return (spine.join(F.broadcast(counts), "rule", "left")
            .select("rule", F.coalesce("fires", F.lit(0)).alias("fires"), F.coalesce("first", F.lit(0)).alias("first"))
            .withColumn("unreachable", (F.col("fires") > 0) & (F.col("first") == 0)))


def labelled_eval(df: DataFrame, labels: DataFrame, predicted: str, label: str, key: str = "doc_id") -> DataFrame:
    """One row: true and false positives and negatives, precision, recall. Only labelled rows count."""
    joined = df.select(key, F.col(predicted).cast("boolean").alias("p")).join(
        labels.select(key, F.col(label).cast("boolean").alias("y")), key)
    counts = joined.agg(F.count_if(F.expr("p and y")).alias("tp"), F.count_if(F.expr("p and not y")).alias("fp"),
                        F.count_if(F.expr("not p and y")).alias("fn"), F.count_if(F.expr("not p and not y")).alias("tn"))
    return _rates(counts)


def threshold_sweep(df: DataFrame, labels: DataFrame, score: str, label: str, thresholds: Sequence[float],
                    key: str = "doc_id") -> DataFrame:
    """One row per threshold: counts and rates of ``score >= threshold``. One join, one aggregation."""
    joined = df.select(key, F.col(score).alias("s")).join(
        labels.select(key, F.col(label).cast("boolean").alias("y")), key)
    counts = (joined.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
              .withColumn("p", F.col("s") >= F.col("threshold")).groupBy("threshold")
              .agg(F.count_if(F.expr("p and y")).alias("tp"), F.count_if(F.expr("p and not y")).alias("fp"),
                   F.count_if(F.expr("not p and y")).alias("fn"), F.count_if(F.expr("not p and not y")).alias("tn")))
    return _rates(counts)


def _rates(counts: DataFrame) -> DataFrame:
    def share(a: str, b: str):
        return F.round(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)), 6)
    return counts.withColumns({"precision": share("tp", "fp"), "recall": share("tp", "fn")})


def fold_of(key: Column, folds: int) -> Column:
    """The fold of a row, from a hash of its key: rows that share a key share a fold."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % folds


def held_out(df: DataFrame, key: str, folds: int, fit: Callable[[DataFrame], object], score: Callable[[DataFrame, object], DataFrame]) -> DataFrame:
    """Every row scored by a model that was fitted to the rows of the other folds."""
    parts = []
    for k in range(folds):
        mine = fold_of(F.col(key), folds) == k
        parts.append(score(df.filter(mine), fit(df.filter(~F.coalesce(mine, F.lit(False))))))
    return reduce(DataFrame.unionByName, parts)


def precision_recall(df: DataFrame, labels: DataFrame, score: str, label: str, bins: int = 1000, key: str = "doc_id") -> DataFrame:
    """The whole curve: a row per threshold that some labelled row reaches, with counts and rates of ``score >= threshold``.

    Scores are cut down to multiples of 1 / ``bins``. Rows are counted per bin first; the running sums go over bins, of which
    there are as many as scores differ, at most ``bins`` + 1 for probabilities.
    """
    joined = df.select(key, (F.floor(F.col(score) * bins) / bins).alias("threshold")).filter("threshold is not null").join(
        labels.select(key, F.col(label).cast("boolean").alias("y")).filter("y is not null"), key)
    counts = joined.groupBy("threshold").agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("n"))
    above, every = Window.orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(F.lit(1))
    tp, fp = F.sum("p").over(above), F.sum("n").over(above)
    curve = counts.select("threshold", tp.alias("tp"), fp.alias("fp"), (F.sum("p").over(every) - tp).alias("fn"), (F.sum("n").over(every) - fp).alias("tn"))
    return _rates(curve).withColumn("f1", F.round(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")), 6))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of the curve with the highest f1; of equals the one with the highest threshold."""
    return curve.groupBy().agg(F.max(F.struct("f1", "threshold", *[c for c in curve.columns if c not in ("f1", "threshold")])).alias("b")).select("b.*")
