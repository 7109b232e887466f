"""Zone maps of the raw zone (S9, K7): the months and products that each file can hold.

A dataset's map is a versioned table ``<root>/<dataset>/_zones`` (Spark's file
listing skips names that start with an underscore) with one row a file: first
and last month, first and last product, rows. It is filled after a write, from
the new files alone, and used to choose files before any of them is opened.

The months are those of the rows, not of the ``year=/month=`` folders, so a
row that arrived late in another month's folder is found. A map never decides
alone what a table holds: files that it doesn't know, or that changed since,
are read whole (``complete=True`` leaves this listing out, for zones that
nobody writes to without updating the map). Rows of chosen files are filtered
again, so the result is that of a full read.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_key
from ..sinks import versions
from . import jsonl

#: The event time of each dataset; products have none.
EVENT_TIME = {"orders": "order_ts", "reviews": "review_ts", "inventory": "snapshot_date"}

ZONES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("first_month", T.DateType()),
        T.StructField("last_month", T.DateType()),
        T.StructField("first_product", T.StringType()),
        T.StructField("last_product", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
_FILE = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}


def map_path(root: str, name: str) -> str:
    return f"{jsonl.dataset_path(root, name)}/_zones"


def _identity() -> list[Column]:
    return [F.col(f"_metadata.{m}").alias(c) for c, m in _FILE.items()]


def listed_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """file, size and modified of every file of a dataset; no content is read."""
    path = jsonl.dataset_path(root, name)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(*_identity())


def _opened(spark: SparkSession, name: str, files: list[str]) -> DataFrame:
    """Raw rows of these files. Their names are URIs: unquoted, and no part of them is a pattern."""
    schema = jsonl.raw_schema(name)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(f)) for f in files])


def _month(name: str) -> Column:
    ts = EVENT_TIME.get(name)
    return month_key(ts) if ts else F.lit(None).cast("date")


def zones_of(spark: SparkSession, name: str, files: list[str]) -> DataFrame:
    """ZONES of some files: one pass over their product and time, one partial row a file and task."""
    raw = _opened(spark, name, files)
    if not files:
        return spark.createDataFrame([], ZONES)
    cols = jsonl.typed_columns(name, raw)
    wanted = [cols[c].alias(c) for c in ("product_id", EVENT_TIME.get(name)) if c]
    rows = raw.select(*_identity(), *wanted)
    zones = rows.groupBy(*_FILE).agg(
        F.min(_month(name)).alias("first_month"),
        F.max(_month(name)).alias("last_month"),
        F.min("product_id").alias("first_product"),
        F.max("product_id").alias("last_product"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return zones.select(*ZONES.fieldNames())


def read_map(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest map of a dataset; no rows if there is none."""
    table = map_path(root, name)
    found = versions.current(spark, table)
    return versions.read(spark, table, ZONES, found) if found else spark.createDataFrame([], ZONES)


def _names(files: DataFrame) -> list[str]:
    """Names of files, for the next read's file list; as many as that read's own listing would hold."""
    return sorted(r.file for r in files.select("file").collect())


def update_map(spark: SparkSession, root: str, name: str) -> int:
    """Bring a dataset's map up to date; returns how many files were opened for it.

    Only new and changed files are read; rows of files that are gone or have
    changed leave the map. A crash before the commit leaves the old map, with
    which every result still is right.
    """
    listed, known = listed_files(spark, root, name), read_map(spark, root, name)
    valid = known.join(listed, list(_FILE), "left_semi").select(*ZONES.fieldNames())
    fresh = _names(listed.join(known, list(_FILE), "left_anti"))
    if not fresh and valid.count() == known.count():
        return 0
    versions.publish(valid.unionByName(zones_of(spark, name, fresh)), map_path(root, name))
    return len(fresh)


def update_maps(spark: SparkSession, root: str) -> dict[str, int]:
    """:func:`update_map` of all datasets."""
    return {name: update_map(spark, root, name) for name in jsonl.DATASETS}


def _first_day(month: str) -> Column:
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"months are written YYYY-MM, not {month!r}")
    return F.lit(f"{month}-01").cast("date")


def _between(low: Column, high: Column, first: Column | None, last: Column | None) -> Column:
    """Whether low..high meets first..last; a bound that is None is open."""
    meets = F.lit(True)
    if first is not None:
        meets = meets & (high >= first)
    if last is not None:
        meets = meets & (low <= last)
    return meets


def chosen_files(
    spark: SparkSession,
    root: str,
    name: str,
    first_month: str | None = None,
    last_month: str | None = None,
    first_product: str | None = None,
    last_product: str | None = None,
    complete: bool = False,
) -> list[str]:
    """The files that can hold rows of these months (``YYYY-MM``) and products, bounds included."""
    zones = known = read_map(spark, root, name)
    if name in EVENT_TIME:
        months = [_first_day(m) if m else None for m in (first_month, last_month)]
        zones = zones.where(_between(F.col("first_month"), F.col("last_month"), *months))
    products = [F.lit(p) if p is not None else None for p in (first_product, last_product)]
    zones = zones.where(_between(F.col("first_product"), F.col("last_product"), *products))
    if complete:
        return _names(zones)
    listed = listed_files(spark, root, name)
    present = zones.join(listed, list(_FILE), "left_semi").select("file")
    return _names(present.unionByName(listed.join(known, list(_FILE), "left_anti").select("file")))


def read_zoned(
    spark: SparkSession,
    root: str,
    name: str,
    first_month: str | None = None,
    last_month: str | None = None,
    first_product: str | None = None,
    last_product: str | None = None,
    complete: bool = False,
) -> DataFrame:
    """Typed rows of these months and products; only files that can hold such rows are opened.

    A bound leaves out rows whose month or product is NULL. Products have no
    month: a month range keeps them all.
    """
    files = chosen_files(spark, root, name, first_month, last_month, first_product, last_product, complete)
    df = jsonl.typed(name, _opened(spark, name, files))
    if name in EVENT_TIME and (first_month or last_month):
        months = [_first_day(m) if m else None for m in (first_month, last_month)]
        df = df.where(_between(_month(name), _month(name), *months))
    if first_product is not None or last_product is not None:
        products = [F.lit(p) if p is not None else None for p in (first_product, last_product)]
        df = df.where(_between(F.col("product_id"), F.col("product_id"), *products))
    return df


def read_months(
    spark: SparkSession, root: str, first_month: str | None = None, last_month: str | None = None, complete: bool = False
) -> dict[str, DataFrame]:
    """All four typed datasets with the activity of these months; the catalogue whole."""
    return {n: read_zoned(spark, root, n, first_month, last_month, complete=complete) for n in jsonl.DATASETS}


def last_month(spark: SparkSession, root: str) -> str | None:
    """``YYYY-MM`` of the newest row that the maps know, from the maps alone."""
    newest = [read_map(spark, root, n).agg(F.max("last_month").alias("m")).first().m for n in EVENT_TIME]
    return max((f"{m:%Y-%m}" for m in newest if m), default=None)
