"""Hilbert-curve sharding (operator 4).

Metadata dimensions are quantised by the cumulative share of their values over
all rows, documents are sorted by their index on the Hilbert curve through that
grid, and the sorted run is cut into shards whose row counts differ by one at
most (law ``rows``), so a shard covers a small box of every dimension and files
can be pruned by it. A dimension of four values spans the curve as one of a
million does.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, ship, stored, utf8_bytes, utf8_crc32

#: Bits of a dimension: 2**BITS cells.
BITS = 5


def default_dimensions() -> dict[str, Column]:
    """Language, source and size in bytes of a document."""
    return {
        "lang": F.col("row.lang"),
        "source": F.col("row.source"),
        "size": utf8_bytes(F.col("row.text")),
    }


def cell(rows: DataFrame, dim: str, total: int, bits: int = BITS) -> Column:
    """Cell of a value: where the middle of its rows lies among all rows in the order of the dimension, null first.

    Whole values are compared. Their counts are added up over range partitions
    of the distinct values; the driver gets the first value of each of the at
    most 2**bits cells.
    """
    values = rows.groupBy(dim).agg(F.count(F.lit(1)).alias("_rows"))
    values = values.repartitionByRange(dim).sortWithinPartitions(dim).withColumn("_at", F.monotonically_increasing_id())
    values = stored(values, "shard-values").withColumn("_part", F.shiftright("_at", 33))
    parts = values.groupBy("_part").agg(F.sum("_rows").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("_part", F.coalesce(earlier, F.lit(0)).alias("_start"))
    upto = F.sum("_rows").over(Window.partitionBy("_part").orderBy("_at"))
    middle = F.col("_start") + F.col("_upto") - F.col("_rows") / 2
    placed = values.withColumn("_upto", upto).join(starts, "_part")
    placed = placed.withColumn("_cell", F.least(F.floor(middle * 2**bits / F.lit(max(total, 1))), F.lit(2**bits - 1)))
    found = placed.groupBy("_cell").agg(F.min(dim).alias("first"), F.bool_or(F.isnull(dim)).alias("null")).orderBy("_cell").collect()

    of_null = next((r["_cell"] for r in found if r["null"]), 0)
    firsts = [(r["first"], r["_cell"]) for r in found if r["first"] is not None]
    if not firsts:
        return F.lit(of_null).cast("int")
    kind = rows.schema[dim].dataType
    reached = F.size(F.filter(F.array(*[F.lit(v).cast(kind) for v, _ in firsts]), lambda v: v <= F.col(dim)))
    return F.when(F.isnull(dim), of_null).otherwise(F.element_at(F.array(*[F.lit(c) for _, c in firsts]), reached)).cast("int")


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points, ``coords[:, d]`` in 0 .. 2**bits - 1.

    The standard transposed form: undo excess work from the top bit down,
    Gray-decode, then interleave the bits of the dimensions.
    """
    x = coords.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> level) & 1)
    return out


def curve(cells: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of a row from its cells."""

    @F.pandas_udf("long")
    def index(values: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(values.to_numpy(), bits))

    return index(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(cells)]))


def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rank`` (from 0, gapless) of every row in the order of ``keys``, without a one-task window.

    A range shuffle sorts the rows; each row notes its place in its partition
    and the stored result gives the partitions' sizes. Only one row per
    partition is summed up in order. Rows alike in all keys are interchangeable.
    """
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    out = placed.join(starts, "_part")
    return out.withColumn("rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop(
        "_at", "_part", "_start", "_n"
    )


def by_rows(total: int, n_shards: int) -> tuple[Column, Column]:
    """Shard and slot of ``rank``: the first ``total % n_shards`` shards take one row more."""
    base, extra = divmod(total, n_shards)
    wide = extra * (base + 1)
    first = F.col("rank") < wide
    thin = max(base, 1)
    shard = F.when(first, F.floor(F.col("rank") / (base + 1))).otherwise(
        extra + F.floor((F.col("rank") - wide) / F.lit(thin))
    )
    slot = F.when(first, F.col("rank") % (base + 1)).otherwise((F.col("rank") - wide) % thin)
    return shard.cast("int"), slot.cast("long")


def hilbert_shards(
    docs: DataFrame,
    n_shards: int = 40,
    dims: dict[str, Column] | None = None,
    bits: int = BITS,
    carry: bool = False,
) -> DataFrame:
    """Shard, slot, Hilbert index and size of every document; ``carry`` keeps the input in ``row``.

    Null metadata sorts first; null text has size 16. Ties on the curve are
    ordered by doc_id and text, so a hot cell is split over tasks and shards.
    An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    dims = dims or default_dimensions()
    rows = packed(docs).select(
        *([F.col("row")] if carry else []),
        F.col("row.doc_id").alias("doc_id"),
        (utf8_bytes(F.col("row.text")) + 16).alias("size"),
        utf8_crc32(F.col("row.text")).alias("text_crc32"),
        *[c.alias(f"_d_{n}") for n, c in dims.items()],
    )
    rows = stored(rows, "shard-keys")
    names = [f"_d_{n}" for n in dims]
    total = rows.count()
    rows = rows.withColumn("hilbert", curve([cell(rows, d, total, bits) for d in names], bits)).drop(*names)
    out = ranked(rows, ["hilbert", "doc_id", "text_crc32", "size"], "shard-order")
    shard, slot = by_rows(total, n_shards)
    return out.withColumn("shard", shard).withColumn("slot", slot)


def sharding_query(docs: DataFrame) -> DataFrame:
    return hilbert_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40) -> None:
    """Write the documents as one folder per shard, rows in curve order; file statistics then prune by dimension.

    An input column named shard or slot gives way to the computed one.
    """
    own = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    out = hilbert_shards(docs, n_shards, carry=True).select(*own, "shard", "slot")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(
        path
    )
