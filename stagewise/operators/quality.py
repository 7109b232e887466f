"""Data-quality reports on the inputs of the fact table.

* duplicate catalogue ids: the left join would repeat that product's monthly
  rows once per copy;
* activity without a catalogue row: kept in the fact table with NULL
  attributes (and classified ``introduction``), listed here for follow-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog_duplicates(products: DataFrame) -> DataFrame:
    """``(product_id, copies)`` for every id that appears more than once."""
    return (
        products.groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def orphan_products(metrics: DataFrame, products: DataFrame) -> DataFrame:
    """Products with activity but no catalogue row, with their active span.

    A product whose catalogue row has empty attributes is no orphan.
    """
    return (
        metrics.join(products.select("product_id"), "product_id", "left_anti")
        .groupBy("product_id")
        .agg(
            F.min("month").alias("first_month"),
            F.max("month").alias("last_month"),
            F.count(F.lit(1)).alias("active_months"),
            F.sum(F.col("revenue").cast("decimal(18,2)")).cast("double").alias("revenue"),
        )
    )
