"""Embedding whitening, with the covariance from variances alone (polarisation).

Entries become whole numbers x, so that every sum below is exact. For each dimension i, and for each
pair of dimensions i < j, the squares of the centred values n*x_i - S_i, and of the centred values
of the sum x_i + x_j, are added up over all rows; S are the sums, n the number of rows. As
2 cov(i, j) = var(i + j) - var(i) - var(j), differences of these variances are all covariances.
The matrix is rounded once, when it is divided into doubles for ``eigh``.

A task adds squares of a batch in digits of ``BITS`` bits and hands on one row per pair and
power; Spark adds these. The driver gets d * (d + 1) / 2 sums of a matrix of d dimensions, whatever
the number of rows. Beyond the range of 64-bit integers the centred values are Python integers.

Rows whose vector is NULL or has NULL or non-finite entries are dropped, as are those with an entry
that is too large for a long (``SCALE`` times its absolute value is 2^62 or more) and those whose
length isn't the most frequent one (of equally frequent ones, the greatest). Repeated rows and ids
each count; an unknown id stays NULL; without rows the result is empty. A component whose
variance is zero (to the precision of doubles) can't be scaled: its values are NULL and it has
no part in the identity error. Equal eigenvalues have no order of their own; LAPACK's is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.llm.common import written

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
BITS = 20
STRIP = 4096
PAIRS = 256

SUMS = "place int, digit int, total bigint"
WHITE = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double"
)


@dataclass(frozen=True)
class Fit:
    """Number of rows, exact sums, and the exact matrix n^3 * covariance times two."""

    n: int
    sums: list[int]
    twice: list[list[int]]

    def covariance(self) -> np.ndarray:
        """Each entry is the correctly rounded quotient of two integers."""
        whole = 2 * self.n**3
        return np.array([[q / whole for q in row] for row in self.twice], float).reshape(
            len(self.sums), len(self.sums)
        )

    def components(self) -> tuple[np.ndarray, np.ndarray]:
        """(eigenvalues falling, unit eigenvectors as rows); the greatest entry is positive."""
        values, vectors = np.linalg.eigh(self.covariance())
        values, vectors = values[::-1], vectors.T[::-1]
        top = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]
        return np.maximum(values, 0), vectors * np.where(top < 0, -1.0, 1.0)[:, None]


def finite_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, their entries as doubles."""
    entries = F.col(vector).cast("array<double>")

    def unfit(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) >= float(2**62 // SCALE))

    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), entries.alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & ~F.exists("vector", unfit))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows"))
    usual = sizes.orderBy(F.desc("rows"), F.desc("size")).first()
    return rows.filter(F.size("vector") == (usual["size"] if usual else 0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, d)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64) + SHIFT


def _strips(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, STRIP):
            part = batch.slice(at, STRIP)
            yield part, whole_numbers(_matrix(part, d))


def _digits(values: np.ndarray, count: int) -> list[np.ndarray]:
    """Digits of ``BITS`` bits, lowest first; the last one has the sign. Any integer dtype."""
    out = []
    for _ in range(count - 1):
        out.append((values & ((1 << BITS) - 1)).astype(np.int64))
        values = values >> BITS
    return [*out, values.astype(np.int64)]


def _rows_of(totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(place, digit, total) of a table of sums, without zeros."""
    place, digit = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(place.astype(np.int32)), pa.array(digit.astype(np.int32)), pa.array(totals[place, digit])],
        ["place", "digit", "total"],
    )


def _added(partial: DataFrame, places: int) -> list[int]:
    """Exact sums by place, from the sums of their digits."""
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    out = [0] * places
    for row in partial.groupBy("place", "digit").agg(total.alias("total")).collect():
        out[row.place] += int(row.total) << (BITS * row.digit)
    return out


def column_sums(vectors: DataFrame, d: int) -> tuple[int, list[int], int]:
    """(rows, exact sum of x per dimension, greatest |x|)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, rows, most = np.zeros((d + 2, 4), np.int64), 0, 0
        for _, x in _strips(batches, d):
            for digit, part in enumerate(_digits(x, 4)):
                totals[:d, digit] += part.sum(axis=0)
            rows += len(x)
            most = max(most, int(np.abs(x).max()))
            if rows >= 1 << 30:
                totals[d, 0] = rows
                yield from _rows_of(totals)
                totals[:], rows = 0, 0
        totals[d, 0] = rows
        yield from _rows_of(totals)
        if most:  # the greatest is kept apart, as it isn't a sum
            yield pa.RecordBatch.from_arrays(
                [pa.array([d + 1], pa.int32()), pa.array([0], pa.int32()), pa.array([most])],
                ["place", "digit", "total"],
            )

    partials = written(vectors.select("vector").mapInArrow(partial, SUMS), "column-sums")
    sums = _added(partials.filter(F.col("place") <= d), d + 1)
    most = partials.filter(F.col("place") == d + 1).agg(F.max("total")).first()[0]
    return sums[d], sums[:d], most or 0


def _centred(x: np.ndarray, n: int, sums: list[int], most: int) -> tuple[np.ndarray, int]:
    """(n*x - S, bits of the greatest absolute value that a sum of two can have)."""
    bits = (2 * n * 2 * max(most, 1)).bit_length()
    if bits >= 62:
        return x.astype(object) * n - np.array(sums, object), bits
    return x * np.int64(n) - np.array(sums, np.int64), bits


def fit(vectors: DataFrame, d: int) -> Fit:
    """Exact sums and covariance of a table of whole vectors; two passes over it."""
    n, sums, most = column_sums(vectors, d)
    first, second = (np.concatenate(p) for p in ((np.arange(d), np.triu_indices(d, 1)[0]),
                                                 (np.full(d, -1), np.triu_indices(d, 1)[1])))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, rows = None, 0
        for _, x in _strips(batches, d):
            z, bits = _centred(x, n, sums, most)
            count = -(-(bits + 1) // BITS)
            if totals is None:
                totals = np.zeros((len(first), 2 * count - 1), np.int64)
            for at in range(0, len(first), PAIRS):
                pairs = slice(at, at + PAIRS)
                other = np.where(second[pairs] < 0, 0, z[:, second[pairs]])
                parts = _digits(z[:, first[pairs]] + other, count)
                for i, a in enumerate(parts):
                    for j in range(i, count):
                        product = np.einsum("rp,rp->p", a, parts[j])
                        totals[pairs, i + j] += product * (1 if i == j else 2)
            rows += len(x)
            if rows >= 1 << 17:  # a digit has 20 bits, a product 41 with its sign and factor
                yield from _rows_of(totals)
                totals[:], rows = 0, 0
        if totals is not None:
            yield from _rows_of(totals)

    squares = _added(vectors.select("vector").mapInArrow(partial, SUMS), len(first)) if n else []
    twice = [[0] * d for _ in range(d)]
    for i in range(d if n else 0):
        twice[i][i] = 2 * squares[i]
    for i, j, both in zip(first[d:], second[d:], squares[d:], strict=bool(n)):
        twice[i][j] = twice[j][i] = both - squares[i] - squares[j]
    return Fit(n, sums, twice)


def project(vectors: DataFrame, fitted: Fit, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component; ``deviation`` is the exact sum of (n*x - S)^2."""
    n, sums = fitted.n, fitted.sums
    d = len(sums)
    values, vecs = fitted.components()
    kept = min(components, d)
    trace = float(np.trace(fitted.covariance()))
    alive = values[:kept] > trace * d * np.finfo(float).eps
    scale = np.sqrt(np.where(alive, values[:kept], 1.0))
    axes = vecs[:kept] / scale[:, None]
    explained = pa.array([v / trace if trace else None for v in values[:kept]], pa.float64())
    most_off = max((max(map(abs, sums)) // max(n, 1)) + 1, 1) if d else 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _strips(batches, d):
            largest = max(int(np.abs(x).max()), most_off)
            z, bits = _centred(x, n, sums, largest)
            if 2 * bits + d.bit_length() >= 62:
                z = z.astype(object)
            deviation = (z * z).sum(axis=1)
            white = (z.astype(float) / n) @ axes.T
            m = len(x)
            repeat = np.repeat(np.arange(m), kept)
            ids = part.column("vec_id").take(pa.array(repeat))
            dead = np.tile(~alive, m)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * kept, n)),
                    pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)).take(pa.array(repeat)),
                    pa.array(white.ravel(), mask=dead),
                    explained.take(pa.array(np.tile(np.arange(kept), m))),
                ],
                [f.split()[0] for f in WHITE.split(", ")],
            )

    return vectors.select("vec_id", "vector").mapInArrow(rows, WHITE)


def identity_error(vectors: DataFrame, fitted: Fit, components: int = COMPONENTS) -> float:
    """Greatest absolute entry of (covariance of the whitened values minus the identity).

    Measured on the rows: means and products of the whitened values are added up over all of them.
    """
    n, sums = fitted.n, fitted.sums
    d = len(sums)
    values, vecs = fitted.components()
    alive = values[:components] > np.trace(fitted.covariance()) * d * np.finfo(float).eps
    axes = (vecs[:components] / np.sqrt(np.where(alive, values[:components], 1.0))[:, None])[alive]
    k = len(axes)
    if not k:
        return 0.0

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k + 1, k))
        for _, x in _strips(batches, d):
            z, _ = _centred(x, n, sums, int(np.abs(x).max()) + max(map(abs, sums)) // n + 1)
            white = (z.astype(float) / n) @ axes.T
            totals[0] += white.sum(axis=0)
            totals[1:] += white.T @ white
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(totals.size, dtype=np.int32)), pa.array(totals.ravel())], ["place", "total"]
        )

    sums_of = vectors.select("vector").mapInArrow(partial, "place int, total double")
    totals = np.zeros((k + 1) * k)
    for row in sums_of.groupBy("place").agg(F.sum("total").alias("total")).collect():
        totals[row.place] = row.total
    totals = totals.reshape(k + 1, k) / n
    return float(np.abs(totals[1:] - np.outer(totals[0], totals[0]) - np.eye(k)).max())


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The vectors whitened: see :func:`project`, with ``identity_error`` on every row."""
    vectors = written(finite_vectors(table, vector), "vectors")
    row = vectors.select(F.size("vector").alias("d")).first()
    d = row.d if row else 0
    if not d:
        empty = vectors.sparkSession.createDataFrame([], WHITE)
        return empty.withColumn("identity_error", F.lit(None).cast("double"))
    fitted = fit(vectors, d)
    error = identity_error(vectors, fitted, components)
    return project(vectors, fitted, components).withColumn("identity_error", F.lit(error))
