"""Spark session defaults and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (measured) size under which AQE turns a shuffle join into a
    # broadcast join; above it the sort-merge join stays.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Do not record a Python call site for every Column expression: it costs
    # several driver round trips per expression while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Settings to start from on a large cluster (~100 TB input, ~1000 executors).
# AQE coalesces small shuffle outputs and splits skewed ones at run time, so
# the partition count is an upper bound, not a target.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    # wide scans: fewer, larger read tasks
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.files.openCostInBytes": "8MB",
    # Static broadcast decisions use compressed file sizes (an estimate), so
    # the static threshold stays at Spark's default; the runtime threshold
    # (DEFAULT_CONF, measured shuffle bytes) decides larger broadcasts.
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = None,
    app_name: str = "stagewise",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the engine's defaults. ``master=None`` keeps the
    cluster's setting (spark-submit); tests pass ``local[*]``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where none
    is set, a local session gets a fresh temporary folder; a cluster session
    raises, since a machine-local folder isn't seen by the other machines.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context handle
        sc = None
    current = sc.getCheckpointDir() if sc is not None and hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        configured = tempfile.mkdtemp(prefix="stagewise-scratch-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each write inside go as it ends, not when the driver's garbage collector meets them.

    For writes whose DataFrame is not run again by the same reference (Spark would make its shuffles anew).
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the scratch folder for one intermediate result."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
