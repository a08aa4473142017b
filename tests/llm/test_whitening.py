import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnwarden.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, x string"


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 4).flatmap(lambda d: st.lists(st.lists(st.one_of(st.integers(-40, 40), st.integers(-2**63, 2**63 - 1)), min_size=d, max_size=d), min_size=1, max_size=70)))
def test_cross_products_equal_integer_arithmetic(rows):
    ones = [[1, *r] for r in rows]
    want = [[sum(r[i] * r[j] for r in ones) for j in range(len(ones[0]))] for i in range(len(ones[0]))]
    found = whitening.cross_products(np.array(rows, np.int64))
    assert found == want
    for row in found:
        assert all(sum(part << 32 * k for k, part in enumerate(whitening.limbs(v))) == v for v in row)


def brute(vectors):
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    d = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], object)
    cov = (d.T.dot(d) / (n ** 3)).astype(float)
    return x, fit, n, sums, cov


def check(rows, vectors_by_id):
    keys = list(vectors_by_id)
    x, fit, n, sums, cov = brute([vectors_by_id[k] for k in keys])
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:16]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(keys)
    table = {}
    for key, v in zip(keys, x):
        found = by[key]
        assert sorted(found) == list(range(1, len(values) + 1))
        dev = [n * c - s for c, s in zip(v, sums)]
        assert all(r.n == n and r.deviation == sum(c * c for c in dev) and r.identity_error < 1e-6 for r in found.values())
        table[v] = [found[k].whitened for k in sorted(found)]
        np.testing.assert_allclose([found[k].explained for k in sorted(found)], values / np.trace(cov), rtol=1e-9, atol=1e-15)
        full = len(values) == len(v)
        if full and None not in table[v]:  # with all components, lengths are Mahalanobis lengths
            dev = np.array([c / n for c in dev])
            np.testing.assert_allclose(np.sum(np.square(table[v])), dev @ np.linalg.solve(cov, dev), rtol=1e-6)
    w = np.array([table[v] for v in fit], float)
    kept = ~np.isnan(w).any(axis=0)
    np.testing.assert_allclose(np.cov(w[:, kept].T, bias=True), np.eye(kept.sum()), atol=1e-6)
    return kept


def test_whitened_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    found = whitening.Whitening(rows).long().collect()
    assert check(found, {r.vec_id: r.embedding for r in rows.collect()}).all()


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = {i: rng.normal(size=5).tolist() for i in range(40)}
    good |= {100 + i: good[0] for i in range(30)} | {200: [3.0, -2.5, 0.015625, -0.015625, 0.0]}
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [1.0, float("nan"), 2.0, 3.0, 4.0]), (904, [float("inf")] * 5), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "clash") for i, v in [*good.items(), *odd]], SCHEMA)
    w = whitening.Whitening(df)
    good = {r.vec_id: r.embedding for r in df.collect() if r.vec_id < 900}  # as floats
    assert check(w.long().collect(), good).all() and w.basis.n == 41
    assert [whitening.Whitening(df.limit(0)).long().count(), whitening.Whitening(df.filter("vec_id in (900, 903)")).long().count()] == [0, 0]
    assert whitening.Whitening(df, dimensions=2).long().select("vec_id").distinct().collect()[0][0] == 905
    ties = df.filter("vec_id = 1").unionByName(df.filter("vec_id = 1")).withColumn("vec_id", F.lit(None).cast("long"))
    one = whitening.Whitening(ties).long().collect()
    assert len(one) == 10 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained == 0 for r in one)


def test_components_without_variance(spark):
    df = spark.createDataFrame([(i, [float(i % 2), float(i % 3), 7.0, float(i % 2)], 1, "") for i in range(60)], SCHEMA)
    rows = whitening.Whitening(df).long().collect()
    assert check(rows, {i: [float(i % 2), float(i % 3), 7.0, float(i % 2)] for i in range(60)}).tolist() == [True, True, False, False]


@pytest.mark.parametrize("largest", [1e9, 1e17, 1e38])
def test_large_entries(spark, largest):
    vectors = {i: [float(np.float32(largest * (i % 5 - 2))), float(i)] for i in range(20)}
    df = spark.createDataFrame([(i, v, 1, "") for i, v in vectors.items()], SCHEMA)
    w = whitening.Whitening(df)
    rows = w.long().collect()
    assert len(rows) == 40 and w.error < 1e-6
    if largest < 1e12:
        x, _, n, sums, _ = brute(vectors.values())
        dev = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in zip(vectors, x)}
        exact = {r.vec_id: int(r.deviation) for r in w.whitened().collect()}
        assert exact == dev
        assert all(r.deviation == (dev[r.vec_id] if dev[r.vec_id] < 2**63 else None) for r in rows)
