"""Nearest neighbours by collision counting (operator 2).

Every block of unit vectors keeps one sorted array for each of ``PROJECTIONS``
random directions. A query opens a window around its own projection in all
arrays; a vector in enough windows is verified by its exact cosine. While the
k-th verified distance is over the radius the windows stand for, the radius
grows and the windows are widened in place (virtual rehashing), so no table is
built anew. Equal vectors are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored


@dataclass(frozen=True)
class Settings:
    """``half``: half of a window for radius 1. ``hit``: the least probability that a vector at the
    radius reaches the collision threshold. ``block``: distinct vectors of a block, about.
    ``sample``: vectors of a block whose k-th distance sets the first radius."""

    projections: int = 96
    half: float = 0.95
    hit: float = 0.98
    growth: float = 1.07
    block: int = 8192
    sample: int = 64
    seed: int = 20

    def threshold(self) -> int:
        """The largest count that a vector at the radius reaches with probability ``hit``."""
        p, m = erf(self.half / sqrt(2)), self.projections
        below = 0.0
        for count in range(m + 1):
            below += comb(m, count) * p**count * (1 - p) ** (m - count)
            if below > 1 - self.hit:
                return count
        return m


class BlockIndex:
    """Sorted projections of one block of vectors (rows of ``x``), all of one length."""

    def __init__(self, x: np.ndarray, k: int, settings: Settings):
        self.x, self.k, self.s = x, k, settings
        self.norm = np.sqrt((x * x).sum(1))
        unit = x / self.norm[:, None]
        rng = np.random.default_rng(settings.seed)
        self.directions = rng.standard_normal((settings.projections, x.shape[1]))
        projected = self.directions @ unit.T
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, 1)
        kind = np.uint16 if len(x) < 1 << 16 else np.uint32
        self.place = np.empty(order.shape, kind)  # where a vector lies in each sorted array
        np.put_along_axis(self.place, order, np.arange(len(x), dtype=kind)[None, :], 1)
        self.needed = settings.threshold()
        some = unit[:: max(1, -(-len(x) // settings.sample))]
        near = np.sort(some @ unit.T, axis=1)[:, -min(k + 1, len(x))]
        self.first = max(0.05, float(np.quantile(np.sqrt(np.maximum(2 - 2 * near, 0)), 0.1)))

    def search(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the verified vectors; the best k of them are the answer."""
        n, qn = len(self.x), sqrt(float(q @ q))
        at = self.directions @ (q / qn)
        score = np.full(n, -np.inf)
        seen = np.zeros(n, bool)
        radius = self.first
        while True:
            if n <= 4 * self.k or radius >= 2:  # no distance on the unit sphere is over 2
                new = ~seen
            else:
                low = np.empty(len(at), self.place.dtype)
                width = np.empty(len(at), self.place.dtype)
                reach = self.s.half * radius
                for i, row in enumerate(self.sorted):
                    a, b = np.searchsorted(row, (at[i] - reach, at[i] + reach))
                    low[i], width[i] = a, b - a
                inside = (self.place - low[:, None]) < width[:, None]  # unsigned: below the window wraps around
                new = (inside.sum(0, dtype=np.uint16) >= self.needed) & ~seen
            rows = np.flatnonzero(new)
            score[rows] = (self.x[rows] @ q) / (self.norm[rows] * qn)
            seen |= new
            if seen.all():
                break
            if seen.sum() >= self.k:
                kth = np.partition(score, n - self.k)[n - self.k]
                if 2 - 2 * kth <= radius * radius:
                    break
            radius *= self.s.growth
        rows = np.flatnonzero(seen)
        return rows, score[rows]


def _best(ids: list[list[int]], rows: np.ndarray, score: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k best (score, id), ties to smaller ids, of the rows' ids."""
    if len(rows) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        rows, score = rows[score >= kth], score[score >= kth]
    found = [(-s, i) for r, s in zip(rows.tolist(), score.tolist(), strict=True) for i in ids[r]]
    return [(-s, i) for s, i in sorted(found)[:k]]


def _search_blocks(batches: Iterator[pa.RecordBatch], k: int, settings: Settings) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, the block's vectors before its queries; queries are streamed."""
    block, index, ids, parts = None, None, [], []
    for b in batches:
        blocks = b.column("block").to_numpy()
        kinds = b.column("is_query").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
        out: list[tuple[int, int, float]] = []
        for a, z in zip([0, *edges], [*edges, len(blocks)], strict=True):
            if a == z:
                continue
            if blocks[a] != block:
                block, index, ids, parts = blocks[a], None, [], []
            run = b.slice(a, z - a)
            size = run.column("dim")[0].as_py()
            x = run.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if not kinds[a]:
                parts.append(x)
                ids += run.column("ids").to_pylist()
                continue
            if not ids:
                continue
            if index is None:
                index = BlockIndex(np.concatenate(parts), k, settings)
            for key, q in zip(run.column("ids").to_pylist(), x, strict=True):
                out += [(key[0], i, s) for s, i in _best(ids, *index.search(q), k)]
        keys, found, scores = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.float64())],
            names=["query_key", "vec_id", "score"],
        )


def usable(vec: Column) -> Column:
    """Whether a vector has components, none null or not finite, and not all 0."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, settings: Settings | None = None,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row where ``queries`` holds (on the id).

    Rows with a null id or an unusable vector take no part; vectors meet only
    those of their own length. Rows with equal vectors are searched and indexed
    once. Repeated (id, vector) rows count once; a query's own id is never its
    neighbour. Fewer than k candidates: all of them. An empty table: no rows.
    """
    s = settings or Settings()
    ship(vectors.sparkSession)
    vec = F.transform(F.col(vector_column).cast("array<double>"), lambda x: x + F.lit(0.0))  # no -0.0
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"))
    rows = stored(rows.where(F.col("id").isNotNull() & usable(F.col("vec"))).distinct(), "vectors")
    # k + 1 ids of a vector are enough: one may be the query's own. The limit applies before the shuffle.
    first = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    entries = rows.withColumn("_n", first).where(F.col("_n") <= k + 1)
    entries = stored(entries.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    asked = rows.where(queries)
    keys = asked.groupBy("vec").agg(F.min("id").alias("query_key"))
    n = max(1, -(-entries.count() // s.block))
    part = F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(n))
    base = entries.select(
        F.size("vec").alias("dim"), part.alias("part"), F.lit(False).alias("is_query"), "ids", "vec"
    )
    every = keys.select(
        F.size("vec").alias("dim"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("part"),
        F.lit(True).alias("is_query"),
        F.array("query_key").alias("ids"),
        "vec",
    )
    work = base.unionByName(every).withColumn("block", F.col("dim") * F.lit(n).cast("long") + F.col("part"))
    work = work.repartition(n, "block").sortWithinPartitions("block", "is_query")
    found = work.select("block", "dim", "is_query", "ids", "vec").mapInArrow(
        lambda b: _search_blocks(b, k + 1, s), "query_key long, vec_id long, score double"
    )
    order = [F.desc("score"), F.asc("vec_id")]
    merged = found.withColumn("_n", F.row_number().over(Window.partitionBy("query_key").orderBy(*order)))
    merged = merged.where(F.col("_n") <= k + 1).drop("_n")
    whose = asked.select(F.col("id").alias("query_id"), "vec").join(keys, "vec").select("query_id", "query_key")
    out = whose.join(merged, "query_key").where(F.col("vec_id") != F.col("query_id"))
    # An id with several vectors asks with each; a neighbour counts with its best score.
    out = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def ann_query(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("id") % 50 == 0)
