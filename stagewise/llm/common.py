"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shuffles_released

#: The word of every text operator here: a run without ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once per context), whatever their working folder."""
    sc = spark.sparkContext
    if getattr(sc, "_stagewise_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="stagewise-pyfile-"), "stagewise_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._stagewise_shipped = True


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(run: Run) -> Run:
    """``run`` for ``mapInArrow``, after which a worker gives its free memory back: it lives on beside other tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            return

    return whole


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared scratch folder and read back.

    Cuts the lineage: a lost executor makes tasks re-read this table, and
    several consumers share one computation, whose shuffle files go with its end. ``codec``: the session's, if none is named.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    writer = df.write.option("compression", codec) if codec else df.write
    with shuffles_released(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that sorts and merges, never broadcast.

    Spark takes a table's size from its file and the kinds of its columns: an array counts as one number and an
    exploded one as one row, so a table of many times the broadcast threshold may seem to be below it.
    """
    return df.hint("merge")


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` as one struct ``row``: no name of the input can clash with an added column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def utf8_bytes(text: Column) -> Column:
    """UTF-8 length of a text; null: 0."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null: that of the empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
