"""Invariants of the fact table and marts on sf0.001."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stagewise.operators import marts, monthly
from stagewise.plans import pipeline
from stagewise.sinks import writers
from stagewise.sources import adapters


@pytest.fixture(scope="module")
def data(spark, sf_small):
    return adapters.datasets(spark, sf_small)


@pytest.fixture(scope="module")
def m0(data):
    return monthly.monthly_metrics(data["products"], data["orders"], data["reviews"], data["inventory"])


def test_scores_in_range(m0):
    (r,) = m0.agg(
        F.min("risk_score"), F.max("risk_score"), F.min("opportunity_score"), F.max("opportunity_score")
    ).collect()
    assert 0.0 <= r[0] <= r[1] <= 100.0 and 0.0 <= r[2] <= r[3] <= 100.0


def test_keys_unique_and_equal_activity(m0, data):
    assert m0.groupBy("product_id", "month").count().filter("count > 1").count() == 0
    act = monthly.activity_months(
        monthly.orders_monthly(data["orders"]), monthly.reviews_monthly(data["reviews"]),
        monthly.inventory_monthly(data["inventory"]),
    )
    keys = m0.select("product_id", "month")
    assert keys.exceptAll(act).count() == 0 and act.exceptAll(keys).count() == 0


def test_fused_equals_joined(data):
    args = (data["products"], data["orders"], data["reviews"], data["inventory"])
    fused = monthly.monthly_fused(*args)
    joined = monthly.monthly_joined(*args).select(*fused.columns)
    assert fused.exceptAll(joined).count() == 0 and joined.exceptAll(fused).count() == 0


def test_trend_revenue_adds_up(m0):
    total = m0.agg(F.sum(F.col("revenue").cast("decimal(18,2)"))).collect()[0][0]
    trend = marts.monthly_trends(m0).agg(F.sum(F.col("revenue").cast("decimal(18,2)"))).collect()[0][0]
    assert total == trend


def test_expected_distribution(m0):
    # Values measured independently for these adapters (see FIXTURES.md).
    stages = dict(m0.groupBy("lifecycle_stage").count().collect())
    assert stages == {"introduction": 4366, "growth": 83, "maturity": 1126, "decline": 2829}
    buckets = dict(m0.groupBy("risk_bucket").count().collect())
    assert buckets == {"critical": 3529, "watch": 809, "stable": 4066}
    assert m0.filter(F.col("age_ratio").isNull()).count() == 0


def test_pipeline_tables_equal_direct(spark, sf_small, tmp_dir, m0):
    paths = pipeline.run_from_tables(spark, sf_small, tmp_dir)
    direct = marts.build_marts(m0)
    for name in direct:
        written = writers.read_mart(spark, tmp_dir, name, ordered=False)
        d = direct[name]
        assert written.exceptAll(d).count() == 0 and d.exceptAll(written).count() == 0, name
    assert set(paths) == {"monthly_metrics", *direct}


def test_fact_table_partitioned_by_month_round_trip(spark, tmp_dir, m0):
    import glob as _glob

    pipeline.write_fact_table(m0, tmp_dir, partition_by_month=True)
    folders = _glob.glob(f"{tmp_dir}/monthly_metrics/_data/*/month=*")
    assert len(folders) == m0.select("month").distinct().count()
    back = pipeline.read_fact_table(spark, tmp_dir)
    assert back.columns == m0.columns
    assert back.exceptAll(m0).count() == 0 and m0.exceptAll(back).count() == 0
    # reading one month prunes to its folder
    one = back.filter(F.col("month") == F.lit("2001-06-01").cast("date"))
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == m0.filter(F.col("month") == F.lit("2001-06-01").cast("date")).count()


FIXTURE_DISTRIBUTIONS = {
    # measured independently for the adapters (FIXTURES.md section 5)
    "0.001": dict(rows=8404, stages=(4366, 83, 1126, 2829), buckets=(3529, 809, 4066), null_age=0,
                  pairs=8204, gaps=3877, latest_n=8),
    "0.01": dict(rows=84618, stages=(45710, 856, 10717, 27335), buckets=(35906, 8136, 40576), null_age=0,
                 pairs=82618, gaps=38814, latest_n=97),
    "0.1": dict(rows=845426, stages=(458473, 8623, 107238, 271092), buckets=(358911, 80987, 405528), null_age=0,
                pairs=825426, gaps=388214, latest_n=940),
}


@pytest.mark.parametrize("sf", sorted(FIXTURE_DISTRIBUTIONS))
def test_fixture_distributions_all_scales(spark, sf):
    import os

    from pyspark.sql import Window

    from stagewise.plans.registry import m0 as build_m0

    path = f"/root/testdata/sf{sf}"
    if not os.path.exists(path):
        pytest.skip("test tables not available")
    m = build_m0(spark, path).cache()
    try:
        st = dict(m.groupBy("lifecycle_stage").count().collect())
        bk = dict(m.groupBy("risk_bucket").count().collect())
        w = Window.partitionBy("product_id").orderBy("month")
        p = m.select(F.lag("month").over(w).alias("prev"), "month").filter(F.col("prev").isNotNull())
        latest = m.agg(F.max("month")).first()[0]
        got = dict(
            rows=m.count(),
            stages=tuple(st[s] for s in ("introduction", "growth", "maturity", "decline")),
            buckets=tuple(bk[b] for b in ("critical", "watch", "stable")),
            null_age=m.filter(F.col("age_ratio").isNull()).count(),
            pairs=p.count(),
            gaps=p.filter(F.add_months("prev", 1) != F.col("month")).count(),
            latest_n=m.filter(F.col("month") == latest).count(),
        )
    finally:
        m.unpersist()
    assert got == FIXTURE_DISTRIBUTIONS[sf]


ADAPTER_COUNTS = {  # products / sales / reviews / inventory rows (FIXTURES.md section 5)
    "0.001": (200, 6_000, 6_000, 6_000),
    "0.01": (2_000, 60_000, 60_000, 60_000),
    "0.1": (20_000, 600_000, 600_000, 600_000),
}


@pytest.mark.parametrize("sf", sorted(ADAPTER_COUNTS))
def test_adapter_row_counts(spark, sf):
    import os

    path = f"/root/testdata/sf{sf}"
    if not os.path.exists(path):
        pytest.skip("test tables not available")
    d = adapters.datasets(spark, path)
    got = tuple(d[n].count() for n in ("products", "orders", "reviews", "inventory"))
    assert got == ADAPTER_COUNTS[sf]


def test_failed_run_keeps_previous_outputs(spark, sf_small, tmp_dir, data):
    from stagewise.sinks import writers

    pipeline.run_from_tables(spark, sf_small, tmp_dir)
    before_fact = pipeline.read_fact_table(spark, tmp_dir)
    n_fact = before_fact.count()
    n_hist = writers.read_mart(spark, tmp_dir, "product_stage_history").count()
    broken = dict(data)
    broken["orders"] = data["orders"].withColumn(
        "quantity", F.when(F.col("quantity") > 0, F.raise_error(F.lit("source failure"))).cast("int")
    )
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, broken, tmp_dir)
    assert pipeline.read_fact_table(spark, tmp_dir).count() == n_fact
    assert writers.read_mart(spark, tmp_dir, "product_stage_history").count() == n_hist
