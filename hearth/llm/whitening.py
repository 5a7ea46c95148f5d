"""Whitening of embeddings by a covariance that is made of variances alone (polarisation).

Entries become integers on a grid, so every sum is exact and no result depends on the order or the
partitions of the rows. The fit list is each distinct vector once. Its squares are summed for every
dimension and for the sum of every pair of dimensions, centred near the mean (the rounded one; what
rounding leaves is taken off exactly at the end), and

    2 cov(i, j) = var(i + j) - var(i) - var(j)

gives all cross-covariances as exact fractions. They are rounded to doubles once, put together as a
matrix and decomposed. Each task adds up its rows and sends one number for each pair of dimensions;
what reaches the driver is bounded by the square of the dimension, whatever the number of vectors.

Equal vectors are collapsed before the shuffle by a partial aggregation, so a vector that a third of
all rows share costs one row a task.

Edge cases: rows whose vector is null or empty, or holds a null, NaN or infinite entry, are left
out, and so are vectors of another dimension than the most frequent one (ties: the largest); repeated vectors
count once in the fit but have rows in the result; null ids are kept; entries beyond 2**40 on the grid
count as that; components whose eigenvalue is not above rounding (1e-12 of the trace) cannot be
whitened and have no rows, so one distinct vector, or none, gives an empty result. The caller names
the columns to carry along; a result column whose name is taken gets underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from hearth.llm.common import col, free, materialize, table

#: Steps of the grid to a unit, and what is added to every entry.
STEPS = 64
OFFSET = 1_000_000
#: Components returned.
COMPONENTS = 16
#: Largest grid value (before the offset), and the least share of the trace that a component needs.
LARGEST = 1 << 40
LEAST_SHARE = 1e-12
#: Vectors handled at once.
ROWS = 2048


class Whitening(NamedTuple):
    """What is fitted: n distinct vectors, the exact sums of their dimensions, unit eigenvectors (columns) with falling
    eigenvalues, the trace, and the largest error of the whitened covariance against the identity."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def to_grid(rows: DataFrame, vector: str = "embedding", carry: Sequence[str] = ("vec_id",), steps: int = STEPS,
            offset: int = OFFSET, name: str = "x") -> DataFrame:
    """``carry`` and the integer vector ``name`` of every row with a finite vector of the common dimension."""
    x, size = free(carry, name), free([*carry, name], "size")
    v = col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    inside = lambda c: F.greatest(F.least(F.floor(c), F.lit(LARGEST)), F.lit(-LARGEST)) + F.lit(offset).cast("bigint")
    within = lambda c: F.greatest(F.least(c * F.lit(float(steps)), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    kept = rows.where(F.coalesce(finite & (F.size(v) > 0), F.lit(False))).select(
        *[col(c) for c in carry], F.transform(v, lambda c: inside(within(c))).alias(x))
    grid = materialize(kept, "grid")
    usual = grid.groupBy(F.size(x).alias(size)).count().orderBy(F.desc("count"), F.desc(size)).first()
    return grid if usual is None else grid.where(F.size(x) == usual[0])


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """A list column without nulls as rows of a matrix."""
    return np.asarray(lists.flatten()).reshape(-1, dims)


def _totals(distinct: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their dimensions."""
    n = 0
    sums: dict[int, int] = {}
    placed = distinct.select(F.posexplode("x").alias("i", "v"))
    for r in placed.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect():
        sums[r.i], n = int(r.s), r.n
    return n, [sums[i] for i in sorted(sums)]


def _square_sums(block: np.ndarray) -> list[int]:
    """Exact sums of squares of the columns; integers of any size where 64 bits might not hold them."""
    most = int(np.abs(block).max(initial=0))
    if most * most * len(block) >= 1 << 63:
        block = block.astype(object)
    return [int(s) for s in np.atleast_1d((block * block).sum(axis=0))]


def _polarised(distinct: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """(i, i): sum of squares of dimension i, centred; (i, j): of the sum of dimensions i and j."""
    dims = len(centre)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {i: [0] * (dims - i) for i in range(dims)}
        for b in batches:
            z = _matrix(b.column(0), dims) - np.array(centre, np.int64)
            for at in range(0, len(z), ROWS):
                own = z[at:at + ROWS]
                for i in range(dims):
                    pairs = own[:, i:] + own[:, i:i + 1]
                    pairs[:, 0] = own[:, i]
                    total[i] = [a + s for a, s in zip(total[i], _square_sums(pairs), strict=True)]
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             pa.array([Decimal(s) for k in range(dims) for s in total[k]], pa.decimal128(38, 0))], names=["i", "j", "squares"])

    sums = distinct.mapInArrow(each, "i int, j int, squares decimal(38,0)").groupBy("i", "j").agg(F.sum("squares").alias("squares"))
    return {(r.i, r.j): int(r.squares) for r in sums.collect()}


def covariance(n: int, sums: Sequence[int], centre: Sequence[int], squares: dict[tuple[int, int], int]) -> list[list[Fraction]]:
    """Exact covariance (divisor n) from the centred square sums of dimensions and of pair sums."""
    dims = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]  # sums of the centred values
    var = [Fraction(n * squares[i, i] - rest[i] ** 2, n * n) for i in range(dims)]
    out = [[Fraction(0)] * dims for _ in range(dims)]
    for i in range(dims):
        out[i][i] = var[i]
        for j in range(i + 1, dims):
            both = Fraction(n * squares[i, j] - (rest[i] + rest[j]) ** 2, n * n)
            out[i][j] = out[j][i] = (both - var[i] - var[j]) / 2
    return out


def _projection(n: int, sums: Sequence[int], vectors: np.ndarray, values: np.ndarray):
    """Function from integer vectors to whitened ones. Vectors are centred exactly at an integer
    first, so that large offsets cost no digits."""
    centre = np.array([s // n for s in sums], np.int64)
    rest = np.array([float(Fraction(s, n) - s // n) for s in sums])
    scale = vectors / np.sqrt(values)
    return lambda x: ((x - centre).astype(np.float64) - rest) @ scale


def _identity_error(distinct: DataFrame, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    dims, k = vectors.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projection(n, sums, vectors, values)
        total, products = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = project(_matrix(b.column(0), dims))
            total += w.sum(axis=0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([products.ravel().tolist()])], names=["s", "p"])

    parts = distinct.mapInArrow(each, "s array<double>, p array<double>")
    add = lambda name: parts.select(F.posexplode(name).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    s, p = np.zeros(k), np.zeros(k * k)
    for of, sums_of in ((s, add("s")), (p, add("p"))):
        for r in sums_of.collect():
            of[r.i] = r.v
    return float(np.abs(p.reshape(k, k) / n - np.outer(s / n, s / n) - np.eye(k)).max())


def fit(grid: DataFrame, x: str = "x", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``grid``; None if nothing varies."""
    distinct = materialize(grid.select(col(x).alias("x")).distinct(), "distinct")
    n, sums = _totals(distinct)
    if not n:
        return None
    centre = [(2 * s + n) // (2 * n) for s in sums]
    cov = covariance(n, sums, centre, _polarised(distinct, centre))
    trace = sum(cov[i][i] for i in range(len(sums)))
    if not trace:
        return None
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int(min(components, (values > LEAST_SHARE * float(trace)).sum()))
    values, vectors = np.ascontiguousarray(values[:k]), np.ascontiguousarray(vectors[:, :k])
    return Whitening(n, sums, vectors, values, float(trace), _identity_error(distinct, n, sums, vectors, values))


def whiten(grid: DataFrame, fitted: Whitening, x: str = "x", carry: Sequence[str] = ("vec_id",)) -> DataFrame:
    """One row for each row of ``grid`` and component: ``carry``, component, n, deviation (decimal,
    exact; null beyond 38 digits), whitened, explained and identity_error."""
    names = [free(carry, c) for c in ("component", "n", "deviation", "whitened", "explained", "identity_error")]
    kept = grid.select(*[col(c) for c in carry], col(x).alias(free(carry, "x")))
    kinds = [IntegerType(), LongType(), DecimalType(38, 0), DoubleType(), DoubleType(), DoubleType()]
    schema = StructType([*kept.schema.fields[:-1], *[StructField(c, t) for c, t in zip(names, kinds, strict=True)]])
    n, sums = fitted.n, fitted.sums
    dims, k = fitted.vectors.shape

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projection(n, sums, fitted.vectors, fitted.values)
        centre = np.array([s // n for s in sums], np.int64)
        rest = np.array([s - n * (s // n) for s in sums], object)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                own = b.slice(at, ROWS)
                m = _matrix(own.column(len(carry)), dims)
                z = m - centre
                most = (int(np.abs(z).max(initial=0)) + 1) * n
                small = most * most * dims < 1 << 63  # else integers of any size
                y = z * n - rest.astype(np.int64) if small else z.astype(object) * n - rest
                far = (y * y).sum(axis=1).tolist()
                at_row = pa.array(np.repeat(np.arange(len(m)), k))
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(at_row) for c in own.columns[:len(carry)]],
                     pa.array(np.tile(np.arange(1, k + 1), len(m)), pa.int32()),
                     pa.array(np.full(len(m) * k, n)),
                     pa.array([Decimal(d) if d < 10**38 else None for d in far], pa.decimal128(38, 0)).take(at_row),
                     pa.array(project(m).ravel()),
                     pa.array(np.tile(fitted.values / fitted.trace, len(m))),
                     pa.array(np.full(len(m) * k, fitted.identity_error))], names=schema.names)

    return kept.mapInArrow(each, schema)


def whiten_embeddings(rows: DataFrame, vector: str = "embedding", carry: Sequence[str] = ("vec_id",),
                      components: int = COMPONENTS, steps: int = STEPS, offset: int = OFFSET) -> DataFrame:
    """All rows with a usable vector, whitened by the covariance of their distinct vectors."""
    x = free(carry, "x")
    grid = to_grid(rows, vector, carry, steps, offset)
    fitted = fit(grid, x, components)
    if fitted is None:
        fitted = Whitening(1, [0], np.zeros((1, 0)), np.zeros(0), 1.0, 0.0)
        grid = grid.where("false")
    return whiten(grid, fitted, x, carry)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation beyond 64 bits (far more vectors than fit the contract's type) is null
    return whiten_embeddings(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
