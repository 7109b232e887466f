"""Raw-zone inventory (S8): how many files and bytes a raw zone holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import human_size


def raw_zone_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """S8: file count, total bytes and readable size of a raw zone.

    Lists files through the ``binaryFile`` source without reading content
    (only ``path``/``length`` are selected), so listing is distributed and
    no file body is loaded.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length")
    return files.agg(
        F.count(F.lit(1)).alias("raw_file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("raw_bytes"),
    ).withColumn("raw_dataset_size", human_size("raw_bytes"))
