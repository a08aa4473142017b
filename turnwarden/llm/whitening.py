"""Embedding whitening over integers: exact cross-products from bit planes, eigenvectors of the covariance, projections.

1. Every entry c becomes the integer floor(64 c) + 1,000,000. The distinct integer vectors, each once, are the fit list; copies of a
   vector meet in a partial aggregation before any shuffle, so a vector that makes up a third of all rows costs one row per task.
2. Batches of the fit list are shifted to the least entry of each dimension, and the bits of the shifted entries are packed across
   rows: a plane per dimension and bit, 64 rows per word. The population count of two planes' AND is how many rows have both bits;
   weighted by 2^(p + q) these counts are the scatter of the batch, without rounding. A plane of ones beside them gives the sums and
   the number of rows in the same way. Shifts are undone in integers, and limbs of 32 bits are added up by Spark.
3. The driver holds one integer matrix of dimensions x dimensions: n * cross - S S', centred before anything is rounded. It is
   divided, decomposed, and its components projected from n * x - S, again an exact integer, in every row's own task.

Work per batch grows with (dimensions x bits)^2 / 64 word operations a row, whatever the number of rows.

Defined results: rows whose vector is null, or holds null, NaN or an infinite entry, go; so do vectors shorter than the longest one,
whose missing entries count as null (``dimensions`` fixes the length instead, and longer ones then go as well); entries beyond the
range of 64-bit integers count as its ends. Repeated rows and ids are rows of their own, a null id stays, ids keep their type. A
component without variance (fewer distinct vectors than dimensions, constant dimensions) has no whitened value (null), and counts
with explained 0. Other columns are not read; an empty table, or one without a usable vector, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from turnwarden.sources.shared import settle

SCALE, BASE, COMPONENTS = 64, 1_000_000, 16
#: Rows whose planes are packed at a time.
ROWS = 8192
#: Limbs of 32 bits that a sum of products may take: two signed 64-bit factors and 2^40 rows.
LIMBS = 6
#: Components with less of the largest variance than this are none: it is what rounding leaves of 0.
LEAST = 1e-13
#: The matrix of dimensions x dimensions is held by the driver, so there is a bound.
MOST_DIMENSIONS = 8192


class Basis(NamedTuple):
    """What a whitening was fitted to: the fit list's size and sums, the components (rows), their variances and the trace."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float


def integers(vector: Column) -> Column:
    """The integer vector of a usable vector, else null."""
    usable = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.when(usable & (F.size(vector) > 0), F.transform(vector, lambda c: F.least(F.floor(c.cast("double") * SCALE).cast("long"), F.lit(2**63 - 1 - BASE)) + BASE))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return vectors.flatten().to_numpy().reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0), np.int64)


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of unsigned integers, packed across rows into words; the column and the bit of each plane."""
    bits = [int(m).bit_length() for m in shifted.max(axis=0)]
    of, bit = np.repeat(np.arange(len(bits)), bits), np.concatenate([np.arange(b) for b in bits] or [np.zeros(0, int)]).astype(np.uint64)
    words = -(-len(shifted) // 64)
    out = np.zeros((len(of), words * 8), np.uint8)
    for k, (d, p) in enumerate(zip(of, bit)):
        packed = np.packbits(((shifted[:, d] >> p) & np.uint64(1)).astype(np.uint8))
        out[k, :len(packed)] = packed
    return out.view(np.uint64), of, bit.astype(np.int64)


def cross_products(x: np.ndarray) -> list[list[int]]:
    """Exact sums of products of all columns, a column of ones put first, from population counts."""
    low = x.min(axis=0)
    shifted = np.ones((len(x), x.shape[1] + 1), np.uint64)
    shifted[:, 1:] = x.view(np.uint64) - low.view(np.uint64)  # modulo 2^64: the difference of any two 64-bit integers
    words, of, bit = planes(shifted)
    size, top = shifted.shape[1], int(bit.max()) + 1
    # counts[s, i, j]: rows with bit p of i and bit q of j, for all p + q = s.
    counts = np.zeros((2 * top - 1, size, size), np.int64)
    for k in range(len(of)):
        both = np.bitwise_count(words[k] & words[k:]).sum(axis=1, dtype=np.int64)
        np.add.at(counts, (bit[k] + bit[k:], of[k], of[k:]), both)
        np.add.at(counts, (bit[k] + bit[k + 1:], of[k + 1:], of[k]), both[1:])
    weights = [1 << s for s in range(2 * top - 1)]
    if 2 * top + int(len(x)).bit_length() < 62:
        products = np.tensordot(np.array(weights, np.int64), counts, 1).tolist()
    else:
        products = [[sum(w * c for w, c in zip(weights, cell)) for cell in row] for row in counts.transpose(1, 2, 0).tolist()]
    # Undo the shift: (y + a)(z + b) = yz + a z + b y + ab, sums of y and z standing in the row of ones.
    shift, n = [0, *low.tolist()], products[0][0]
    sums = products[0]
    return [[products[i][j] + shift[i] * sums[j] * (i > 0) * (j > 0) + shift[j] * sums[i] * (i > 0) * (j > 0) + shift[i] * shift[j] * n if i and j
             else products[i][j] + n * (shift[i] + shift[j]) for j in range(size)] for i in range(size)]


def limbs(value: int) -> list[int]:
    """``value`` in base 2^32, the last limb with the sign."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & 0xFFFFFFFF)
        value >>= 32
    return [*out, value]


def scatter(fit: DataFrame, rows: int = ROWS) -> tuple[int, list[int], list[list[int]]]:
    """The number of vectors in ``fit`` (x), their sums and their sums of products, exactly. What reaches the driver is one
    number per two dimensions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                found = np.array(cross_products(matrix(batch.column(0).slice(start, rows))), object)
                total = found if total is None else total + found
        if total is not None:
            at = [(i, j) for i in range(len(total)) for j in range(i, len(total))]
            parts = list(zip(*(limbs(total[i, j]) for i, j in at)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in zip(*at)] + [pa.array(p, pa.int64()) for p in parts],
                                             ["i", "j", *(f"l{k}" for k in range(LIMBS))])

    names = [f"l{k}" for k in range(LIMBS)]
    found = fit.select("x").mapInArrow(run, "i int, j int, " + ", ".join(f"{n} long" for n in names))
    table = {(r["i"], r["j"]): sum(int(r[f"s{k}"]) << 32 * k for k in range(LIMBS))
             for r in found.groupBy("i", "j").agg(*(F.sum(n).alias(f"s{k}") for k, n in enumerate(names))).collect()}
    size = max((j for _, j in table), default=0)
    return (table.get((0, 0), 0), [table[0, j] for j in range(1, size + 1)],
            [[table[min(i, j), max(i, j)] for j in range(1, size + 1)] for i in range(1, size + 1)])


def decomposed(n: int, sums: list[int], products: list[list[int]], components: int) -> Basis:
    """Eigenvectors of the covariance, by falling variance; it is centred in integers and rounded once, at the division."""
    size = len(sums)
    # An int divided by an int is the double next to the quotient, however large both are.
    covariance = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(size)] for i in range(size)], float).reshape(size, size)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    values, top = values[order], max(float(values.max(initial=0.0)), 0.0)
    return Basis(n, sums, vectors.T[order], np.where(values > LEAST * top, values, 0.0), float(np.trace(covariance)))


def deviations(x: np.ndarray, basis: Basis) -> np.ndarray:
    """n * x - S, exactly: 64-bit integers where they hold it, else Python's."""
    n, sums = basis.n, basis.sums
    largest = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    if n * largest + max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def projected(x: np.ndarray, basis: Basis) -> np.ndarray:
    """Whitened values, a column per component; NaN for one without variance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        centred = (deviations(x, basis) / basis.n).astype(float)
        return np.where(basis.variances > 0, centred @ basis.vectors.T / np.sqrt(basis.variances), np.nan)


def squares(x: np.ndarray, basis: Basis) -> list[int]:
    """Per row the sum of (n * x - S)^2, exactly."""
    d = deviations(x, basis)
    if d.dtype != object and (int(np.abs(d).max(initial=0)) ** 2) * max(d.shape[1], 1) < 1 << 62:
        return (d * d).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in d]


def identity_error(fit: DataFrame, basis: Basis) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the fit list."""
    kept = np.flatnonzero(basis.variances > 0)
    if not len(kept):
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(kept) + 1, len(kept)))
        for batch in batches:
            w = projected(matrix(batch.column(0)), basis)[:, kept]
            total[:-1] += w.T @ w
            total[-1] += w.sum(axis=0)
        at = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total.ravel())], ["i", "j", "s"])

    cells = fit.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((len(kept) + 1, len(kept)))
    for r in cells:
        total[r["i"], r["j"]] = r["s"] / basis.n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(kept))).max())


class Whitening:
    """A whitening fitted to a table: ``rows`` (id, x), ``fit`` (the distinct x) and its ``basis``; None for the last if no row is
    usable."""

    def __init__(self, table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, dimensions: int | None = None):
        usable = table.select(F.col(vec_id).alias("vec_id"), integers(F.col(embedding)).alias("x")).filter("x is not null")
        fit = usable.select("x").distinct()
        if dimensions is not None:
            fit = fit.filter(F.size("x") == dimensions)
        fit = settle(fit, "whitening-fit")
        size = dimensions or fit.agg(F.max(F.size("x"))).first()[0] or 0
        if size > MOST_DIMENSIONS:
            raise ValueError(f"{size} dimensions; at most {MOST_DIMENSIONS}")
        self.rows, self.fit = usable.filter(F.size("x") == size), fit.filter(F.size("x") == size)
        n, sums, products = scatter(self.fit)
        self.basis = decomposed(n, sums, products, components) if n else None
        self.error = identity_error(self.fit, self.basis) if n else 0.0

    def whitened(self) -> DataFrame:
        """A row per usable vector: vec_id, ``deviation`` (exact), ``whitened`` (a value per component, null without variance)."""
        kind, basis = self.rows.schema["vec_id"], self.basis
        schema = T.StructType([kind, T.StructField("deviation", T.StringType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column(1))
                    values = projected(x, basis)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), from_pandas=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(str, squares(x, basis)), pa.string()), lists], schema=arrow)

        return self.rows.filter(F.lit(basis is not None)).mapInArrow(run, schema)

    def long(self) -> DataFrame:
        """A row per usable vector and component, numbered from 1: vec_id, component, n, deviation (null beyond 64 bits), whitened,
        explained, identity_error."""
        b = self.basis
        shares = [float(v / b.trace) if b.trace > 0 else 0.0 for v in b.variances] if b else []
        return self.whitened().select("vec_id", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("whitened").alias("k", "whitened")).select(
            "vec_id", (F.col("k") + 1).alias("component"), F.lit(b.n if b else 0).cast("long").alias("n"), "deviation", "whitened",
            F.element_at(F.array(*map(F.lit, shares or [0.0])), F.col("k") + 1).alias("explained"), F.lit(self.error).alias("identity_error"))
