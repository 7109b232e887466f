"""Java compiles no method of more than 8,000 bytes: such code of a stage runs interpreted, ten times slower."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from stagewise.llm import line_dedup
from stagewise.llm.common import stored


def longest_method(df) -> int:
    spark = df.sparkSession
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution()
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    return max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.fixture
def found(spark):
    sig = F.transform(F.sequence(F.lit(1), F.lit(line_dedup.BINS)), lambda k: (F.col("id") % (k + 3)).cast("int"))
    return stored(spark.range(300).select("id", (F.col("id") + 40).alias("size"), sig.alias("sig")), "found")


def test_bucket_members_are_compiled(found):
    assert longest_method(line_dedup.bucket_members(found, line_dedup.Settings())) < 8000


def test_empty_bands_and_single_lines_are_in_no_bucket(found):
    rows = line_dedup.bucket_members(found, line_dedup.Settings()).collect()
    sigs = {r.id: r.sig for r in found.collect()}
    keys = [(i, t, *[x[b] for b in band]) for i, x in sigs.items() for t, band in enumerate(line_dedup.BANDS) if any(x[b] for b in band)]
    many = [k[1:] for k in keys]
    assert {(r.id, r.band) for r in rows} == {k[:2] for k in keys if many.count(k[1:]) > 1}
