"""Batch pipeline: raw datasets -> monthly_metrics table -> seven marts.

The scored fact table is computed once and **written** (Parquet) before the
marts are derived from the written copy. That cuts the lineage: a lost
executor while building marts re-reads the table instead of re-scanning raw
data, and the seven mart jobs never recompute the joins/aggregation/window.
Mart writes are independent jobs and are submitted concurrently.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.marts import MART_BUILDERS
from ..operators.monthly import monthly_metrics
from ..schemas import MONTHLY_METRICS
from ..sinks import versions
from ..sinks.writers import write_mart, write_mart_jdbc
from ..sources import adapters, jsonl, zone_map

FACT_TABLE = "monthly_metrics"


def write_fact_table(metrics: DataFrame, out_root: str, partition_by_month: bool = False) -> str:
    """Write the fact table as a new version (see :mod:`stagewise.sinks.versions`)."""
    path = f"{out_root.rstrip('/')}/{FACT_TABLE}"
    by = None
    if partition_by_month:
        # Range partitioning on (month, product): each task holds a contiguous
        # slice, so it writes one or two month folders (few files), and a month
        # holding a third of the rows is split over several tasks.
        metrics, by = metrics.repartitionByRange("month", "product_id"), "month"
    if versions.has_file_system(metrics.sparkSession):
        versions.publish(metrics, path, partition_by=by)
    else:
        writer = metrics.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
    return path


def read_fact_table(spark: SparkSession, out_root: str) -> DataFrame:
    df = versions.read(spark, f"{out_root.rstrip('/')}/{FACT_TABLE}", MONTHLY_METRICS)
    return df.select(*MONTHLY_METRICS.fieldNames())


def run_pipeline(
    spark: SparkSession,
    datasets: dict[str, DataFrame],
    out_root: str,
    mode: str = "replace",
    fused: bool = True,
    partition_by_month: bool = False,
    parallel_marts: int = 7,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Build and write the fact table and the marts; returns their locations.

    The fact table always goes to ``out_root`` (Parquet). Marts go there too,
    or to a SQL database when ``jdbc_url`` is given (executors insert in
    parallel; ``replace`` recreates the tables, ``append`` inserts).
    """
    metrics = monthly_metrics(
        datasets["products"], datasets["orders"], datasets["reviews"], datasets["inventory"], fused=fused
    )
    paths = {FACT_TABLE: write_fact_table(metrics, out_root, partition_by_month)}
    table = read_fact_table(spark, out_root)

    def build_and_write(name: str) -> str:
        # Planning and running each mart in its own thread overlaps the
        # driver-side analysis of one mart with the execution of another.
        mart = MART_BUILDERS[name](table)
        if jdbc_url:
            write_mart_jdbc(mart, jdbc_url, name, mode, jdbc_properties)
            return f"{jdbc_url}#{name}"
        return write_mart(mart, out_root, name, mode)

    with ThreadPoolExecutor(max_workers=max(1, parallel_marts)) as pool:
        futures = {name: pool.submit(build_and_write, name) for name in MART_BUILDERS}
        for name, fut in futures.items():
            paths[name] = fut.result()
    return paths


def run_from_raw(
    spark: SparkSession, raw_root: str, out_root: str, first_month: str | None = None, last_month: str | None = None, **kw
) -> dict[str, str]:
    """Pipeline over a JSON-lines raw zone (any Hadoop URI).

    With a month range (``YYYY-MM``, ends included) the tables cover the
    activity of these months alone: only files that can hold it are opened
    (see :mod:`stagewise.sources.zone_map`), and a product's first month of the
    range has no month before it.
    """
    if first_month or last_month:
        datasets = zone_map.read_months(spark, raw_root, first_month, last_month)
    else:
        datasets = jsonl.read_raw_zone(spark, raw_root)
    return run_pipeline(spark, datasets, out_root, **kw)


def run_from_tables(spark: SparkSession, sf_dir: str, out_root: str, **kw) -> dict[str, str]:
    """Pipeline over the TPC-H-style parquet tables through the adapters."""
    return run_pipeline(spark, adapters.datasets(spark, sf_dir), out_root, **kw)
