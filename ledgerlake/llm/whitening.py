"""Whitening of embeddings by shifted CholeskyQR.

Vectors are made integer, so that their number and sums are exact; a row is centred as
(n * x - S) / n before anything is multiplied. Each pass over the rows sums the Gram matrix of the
centred rows, solved through the triangular factors found so far; its Cholesky factor (of the
first one with a small multiple of the identity added, so that it exists for any condition)
makes them more orthogonal. After about three passes the rows are Q R with orthonormal Q and R the product of
the factors, and the singular values and vectors of the small R give the components.

Tasks return one matrix a partition; only sums of them, of the size of the dimension squared, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import trimmed

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
LIMIT = float(1 << 52)  # from here on a scaled entry has no exact place among the integers
PASSES, ROWS = 8, 2048
FLAT = 1e-11  # of the largest singular value: what is smaller is the rounding of a direction without variance
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
HALF = 26


def _matrices(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer matrix) of the valid vectors of a list column, some rows at a time."""
    column = column.cast(pa.large_list(pa.float64()))
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    valid = np.asarray(column.is_valid()) & (np.diff(edges) == size)
    values = column.values
    flat, there = values.fill_null(np.nan).to_numpy(zero_copy_only=False), np.flatnonzero(valid)
    for a in range(0, len(there), ROWS):
        rows = there[a : a + ROWS]
        c = flat[edges[rows][:, None] + np.arange(size)]
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(SCALE * c)
            fine = (np.abs(scaled) < LIMIT).all(axis=1)  # not for NaN
        yield rows[fine], scaled[fine].astype(np.int64) + OFFSET


@dataclass
class Center:
    """Exact number and sums of the rows."""

    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S; as Python integers where 64 bits could overflow."""
        low = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = x - low
        if (int(np.abs(away).max(initial=0)) + 1) * self.n >= 1 << 62:
            return away.astype(object) * self.n - rest
        return away * self.n - rest

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of squares of n * x - S; None where no long holds it."""
        y = self.scaled(x)
        if y.dtype == object or int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] >= 1 << 63:
            exact = (y.astype(object) ** 2).sum(axis=1).tolist()
            return [v if v < 1 << 63 else None for v in exact]
        return (y * y).sum(axis=1).tolist()


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = rows for an upper triangular R, by forward substitution over the columns."""
    a = np.ascontiguousarray(rows.T)
    for j in range(len(a)):
        a[j] = (a[j] - r[:j, j] @ a[:j]) / r[j, j]
    return a.T


@dataclass
class Whitening:
    """The fitted components: columns of ``axes``, their variances, the share of the trace, and what is left to the identity."""

    center: Center
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.center.rows(x) @ self.axes / np.sqrt(self.variances)


def _summed(vectors: DataFrame, size: int, make: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of ``make(matrix of rows)``, of the given shape."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            for _, x in _matrices(batch.column(0), size):
                total += make(x)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "value"])

    sums = vectors.select("v").mapInArrow(trimmed(run), "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(int(np.prod(shape)))
    for row in sums.collect():  # as many as the shape has entries
        out[row["at"]] = row["value"]
    return out.reshape(shape)


def center(vectors: DataFrame, size: int) -> Center:
    """Exact sums, added up in two halves of 26 bits so that no long overflows below 2 ** 36 rows."""

    def run(batches):
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for _, x in _matrices(batch.column(0), size):
                n += len(x)
                high += (x >> HALF).sum(axis=0)
                low += (x & ((1 << HALF) - 1)).sum(axis=0)
        at = np.arange(size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(size, n)), pa.array(high), pa.array(low)], names=["at", "n", "high", "low"])

    sums = vectors.select("v").mapInArrow(trimmed(run), "at int, n long, high long, low long")
    rows = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("at").collect()
    return Center(rows[0]["n"] if rows else 0, [(r["high"] << HALF) + r["low"] for r in rows])


def triangular(gram: Callable[[list[np.ndarray]], np.ndarray], n: int, passes: int = PASSES) -> np.ndarray:
    """R with rows = Q R, from the Gram matrix of the rows solved through the factors that it is given.

    The first pass is shifted, and a later one if its matrix has no Cholesky factor. Directions
    without variance never become orthonormal; the root of the last Gram matrix then closes the product.
    """
    factors: list[np.ndarray] = []
    for k in range(passes):
        g = gram(factors)
        size = len(g)
        if not np.trace(g) > 0:
            break
        if k and np.abs(g - np.eye(size)).max() < 4e-15 * size:
            break
        shift = 11 * (n * size + size * (size + 1)) * 2.0**-53 * np.trace(g)
        try:
            low = np.linalg.cholesky(g + shift * np.eye(size) if not k else g)
        except np.linalg.LinAlgError:
            low = np.linalg.cholesky(g + shift * np.eye(size))
        factors.append(low.T)
    else:
        g = gram(factors)
    value, vector = np.linalg.eigh(g)
    r = np.sqrt(np.maximum(value, 0))[:, None] * vector.T
    for f in reversed(factors):
        r = r @ f
    return r


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The components of a frame with a column ``v`` (list of doubles), which is read once a pass; None without variance.

    The size is the most frequent one among the vectors (the larger on ties).
    """
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is the largest
    first = vectors.filter(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0)).groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if first is None:
        return None
    size = first["size"]
    mid = center(vectors, size)
    if not mid.n:
        return None

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def make(x):
            a = mid.rows(x)
            for r in factors:
                a = solved(a, r)
            return a.T @ a

        return _summed(vectors, size, make, (size, size))

    r = triangular(gram, mid.n)
    _, sigma, axes = np.linalg.svd(r)
    keep = int((sigma > FLAT * sigma[0]).sum())
    if not keep:
        return None
    spread = sigma * sigma / mid.n
    use = min(components, keep)
    out = Whitening(mid, axes[:use].T.copy(), spread[:use], spread[:use] / spread[:keep].sum())
    mean = _summed(vectors, size, lambda x: out.rows(x).sum(axis=0), (use,)) / mid.n

    def second(x):
        z = out.rows(x) - mean
        return z.T @ z

    out.identity_error = float(np.abs(_summed(vectors, size, second, (use, use)) / mid.n - np.eye(use)).max())
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each valid vector and component.

    Vectors that are null or hold null or non-finite entries are dropped; so are vectors of another
    length than the most frequent one and entries whose scaled value 52 bits do not hold. Rows are
    independent: repeated rows and ids count and come out as often as they stand there, null ids
    stay null. Components without variance are left out (less than ``components`` rows a vector), so
    an empty table, one row or equal rows give an empty result. With tied variances any basis of
    their space may come out. A deviation that no long holds is null. Other columns are ignored.
    The input is read in each pass: give a stored table.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    model = fit(rows, components)
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    size, use = model.axes.shape

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, x in _matrices(batch.column(1), size):
                if not len(at):
                    continue
                k = len(at)
                each = np.repeat(np.arange(k), use)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at[each])),
                        pa.array(np.tile(np.arange(1, use + 1, dtype=np.int32), k)),
                        pa.array(np.full(k * use, model.center.n)),
                        pa.array(model.center.deviation(x), pa.int64()).take(pa.array(each)),
                        pa.array(model.rows(x).ravel()),
                        pa.array(np.tile(model.explained, k)),
                        pa.array(np.full(k * use, model.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(trimmed(run), SCHEMA)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
