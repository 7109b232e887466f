"""Embedding whitening by pivoted Cholesky and one-sided Jacobi (operator 12).

Spark sums up the statistics in passes over all vectors: column sums, then the
scatter of the centred vectors. The covariance V (dimensions x dimensions, all
that the driver holds) is factored as V = P L L' P' with pivoting, which also
shows its rank. Rotations from the right make the columns of L orthogonal,
without ever forming a product of L: their squared norms are the eigenvalues
and the columns scaled to length one, rows put back in order, the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stored

#: The entry c counts as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Rows of numpy matrices worked on at a time.
ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """``rank_tolerance``: pivots up to this share of the trace end the factorization (the rest is rounding)."""

    components: int = 32
    rank_tolerance: float = 1e-13


@dataclass(frozen=True)
class Whitening:
    """``sums`` (exact) over ``n`` vectors; ``values`` and ``vectors`` (columns): eigenpairs by falling value."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def pivoted_cholesky(v: np.ndarray, tolerance: float = 1e-13) -> tuple[np.ndarray, np.ndarray]:
    """L (rows in pivot order, as many columns as the rank) and the pivot order of a positive semidefinite matrix."""
    a, d = v.astype(np.float64).copy(), len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    limit = tolerance * max(np.trace(v), 0.0)
    for k in range(d):
        p = k + int(np.argmax(np.diagonal(a)[k:]))
        if not a[p, p] > limit:
            return factor[:, :k], order
        for m in (a, factor):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs."""
    ring = np.arange(n + n % 2)
    for _ in range(len(ring) - 1):
        a, b = ring[: len(ring) // 2], ring[::-1][: len(ring) // 2]
        real = (a < n) & (b < n)
        yield a[real], b[real]
        ring[1:] = np.roll(ring[1:], 1)


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns made orthogonal by rotations from the right, to rounding."""
    g, eps = factor.copy(), np.finfo(float).eps
    for _ in range(sweeps):
        still = True
        for a, b in _rounds(g.shape[1]):
            x, y = g[:, a], g[:, b]
            p, q, r = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(r) > eps * np.sqrt(p * q)
            if not turn.any():
                continue
            still = False
            a, b, x, y, p, q, r = a[turn], b[turn], x[:, turn], y[:, turn], p[turn], q[turn], r[turn]
            z = (q - p) / (2 * r)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1.0, z))
            c = 1 / np.hypot(1.0, t)
            g[:, a], g[:, b] = c * (x - t * y), c * (t * x + y)
        if still:
            break
    return g


def eigenpairs(v: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues over rounding, falling, and unit eigenvectors as columns, the largest entry of each positive."""
    factor, order = pivoted_cholesky(v, s.rank_tolerance)
    g = jacobi_columns(factor)
    norms = np.sqrt((g * g).sum(0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.empty((len(v), len(by)))
    vectors[order] = g[:, by] / norms[by]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(by))]) if len(by) else np.ones(0)
    return norms[by] ** 2, vectors * sign


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrices of the batch's vectors that take part, of one length each."""
    lists = batch.column(column)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        for k in range(0, len(rows), ROWS):
            some = rows[k : k + ROWS]
            flat = lists.take(pa.array(some)).flatten()
            m = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)  # null: NaN
            whole = np.isfinite(m).all(1)
            whole[whole] = (np.abs(m[whole]) < 2.0**56).all(1)
            if whole.any():
                yield some[whole], m[whole]


def _scaled(m: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * m).astype(np.int64) + OFFSET


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: 64-bit numbers where they surely fit, Python's else."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _summed(rows: DataFrame, columns: list[str], of: Callable[[pa.RecordBatch], Iterator[tuple]], schema: str) -> list:
    """The sums of ``value`` by the other columns over what each task adds up; ``of`` gives (key, values) of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for b in batches:
            for key, values in of(b):
                total[key] = total[key] + values if key in total else values
        for key, values in total.items():
            yield _sum_rows(key, values)

    return rows.select(*columns).mapInArrow(run, schema)


def _sum_rows(key: tuple, values: np.ndarray) -> pa.RecordBatch:
    at = np.arange(values.size)
    exact = values.dtype == object
    value = pa.array([Decimal(int(v)) for v in values.ravel()], pa.decimal128(38, 0)) if exact else pa.array(values.ravel())
    keys = [pa.array(np.full(values.size, k, np.int64)) for k in key]
    return pa.RecordBatch.from_arrays([*keys, pa.array(at, pa.int64()), value], names=[*(f"k{i}" for i in range(len(key))), "at", "value"])


def column_sums(rows: DataFrame, column: str) -> tuple[int, int, tuple[int, ...]]:
    """Dimensions, number and exact column sums of the vectors of the commonest length (ties: the longest)."""

    def of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for _, m in _matrices(batch, column):
            x = _scaled(m)
            small = int(np.abs(x).max()) * len(x) < 1 << 62
            sums = x.sum(0).astype(object) if small else x.astype(object).sum(0)
            yield (x.shape[1],), np.concatenate([np.array([len(x)], object), sums])

    parts = _summed(rows, [column], of, "k0 long, at long, value decimal(38,0)")
    sums = parts.groupBy("k0", "at").agg(F.sum("value").cast("decimal(38,0)").alias("value"))
    sums = stored(sums, "whitening-sums")
    best = sums.where("at = 0").orderBy(F.desc("value"), F.desc("k0")).first()
    if best is None:
        return 0, 0, ()
    d = best["k0"]
    found = {r["at"]: int(r["value"]) for r in sums.where(F.col("k0") == d).collect()}  # d + 1 rows
    return d, found[0], tuple(found[k + 1] for k in range(d))


def scatter(rows: DataFrame, column: str, centred: Callable[[np.ndarray], np.ndarray], d: int, out: int) -> np.ndarray:
    """Sum of c c' over the rows' centred vectors c (``out`` entries) of the vectors with d entries."""

    def of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for _, m in _matrices(batch, column):
            if m.shape[1] == d:
                c = centred(m)
                yield (0,), c.T @ c

    parts = _summed(rows, [column], of, "k0 long, at long, value double")
    total = np.zeros(out * out)
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).toLocalIterator():  # out * out rows
        total[r["at"]] = r["value"]
    total = total.reshape(out, out)
    return (total + total.T) / 2


def fit(rows: DataFrame, column: str, settings: Settings | None = None) -> Whitening:
    """The whitening of all vectors that take part."""
    s = settings or Settings()
    ship(rows.sparkSession)
    d, n, sums = column_sums(rows, column)
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    v = scatter(rows, column, lambda m: (_deviations(_scaled(m), n, sums) / n).astype(np.float64), d, d) / n
    values, vectors = eigenpairs(v, s)
    return Whitening(n, sums, values[: s.components], vectors[:, : s.components], float(np.trace(v)))


def transformed(rows: DataFrame, column: str, w: Whitening, key: str = "vec_id") -> DataFrame:
    """``key``, deviation (exact; null where it does not fit a long) and whitened (array) of the vectors that take part."""
    d, scale = len(w.sums), w.vectors / np.sqrt(w.values) if len(w.values) else np.zeros((len(w.sums), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, m in _matrices(b, column):
                if m.shape[1] != d:
                    continue
                far = _deviations(_scaled(m), w.n, w.sums)
                if far.dtype != object and int(np.abs(far).max()) ** 2 * d >= 1 << 63:
                    far = far.astype(object)
                square = [int(v) if int(v) < 1 << 63 else None for v in (far * far).sum(1)]
                white = (far / w.n).astype(np.float64) @ scale
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(at)), pa.array(square, pa.int64()), lists], names=[key, "deviation", "whitened"])

    kind = rows.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return rows.select(key, column).mapInArrow(run, schema)


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (k entries) minus the identity; 0 without components."""
    if not k:
        return 0.0
    means = np.zeros(k)
    for r in white.select(F.posexplode("whitened").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():  # k rows
        means[r["at"]] = r["v"] / n
    return float(np.abs(scatter(white, "whitened", lambda m: m - means, k, k) / n - np.eye(k)).max())


def whitened(rows: DataFrame, column: str = "embedding", key: str = "vec_id", settings: Settings | None = None) -> DataFrame:
    """One row for each vector that takes part and component: see ``whitening_query``.

    Vectors that are null, empty, or hold a null or non-finite entry, one of
    2**56 or more (its x is no long) or another number of entries than most
    vectors take no part. Repeated rows count and return as often as they
    occur; a null key is kept. There are as many components as the covariance
    has rank, up to the setting: none for one vector or equal ones, and then,
    as for an empty table, no rows.
    """
    w = fit(rows, column, settings)
    white = stored(transformed(rows, column, w, key), "whitening-rows")
    error = identity_error(white, w.n, len(w.values)) if w.n else 0.0
    share = F.array(*[F.lit(float(v / w.trace)) for v in w.values]) if len(w.values) else F.array().cast("array<double>")
    out = white.select(key, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return out.select(
        key, (F.col("_at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def whitening_query(embeddings: DataFrame) -> DataFrame:
    return whitened(embeddings)
