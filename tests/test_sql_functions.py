"""SQL-function form of the scoring rules agrees with the column form."""

from __future__ import annotations

from stagewise.functions import lifecycle_stage, opportunity_score, risk_bucket, risk_score
from stagewise.functions.sql import register_sql_functions
from stagewise.plans.registry import m0 as build_m0


def test_sql_functions_match_columns(spark, sf_small):
    register_sql_functions(spark, prefix="sw_")
    m = build_m0(spark, sf_small)
    m.createOrReplaceTempView("sw_m0")
    via_sql = spark.sql(
        "SELECT product_id, month, "
        "sw_lifecycle_stage(age_ratio, revenue_change, avg_sentiment, sell_through_pct) AS stage, "
        "sw_risk_score(sentiment_delta, revenue_change, return_rate, stockout_ratio) AS risk, "
        "sw_opportunity_score(avg_sentiment, revenue_change, review_count) AS opp, "
        "sw_risk_bucket(risk_score) AS bucket FROM sw_m0"
    )
    via_cols = m.select(
        "product_id", "month",
        lifecycle_stage("age_ratio", "revenue_change", "avg_sentiment", "sell_through_pct").alias("stage"),
        risk_score("sentiment_delta", "revenue_change", "return_rate", "stockout_ratio").alias("risk"),
        opportunity_score("avg_sentiment", "revenue_change", "review_count").alias("opp"),
        risk_bucket("risk_score").alias("bucket"),
    )
    assert via_sql.exceptAll(via_cols).count() == 0 and via_cols.exceptAll(via_sql).count() == 0
    # and the stored columns are what the rules give
    stored = m.select("product_id", "month", "lifecycle_stage", "risk_score", "opportunity_score", "risk_bucket")
    assert stored.exceptAll(via_cols).count() == 0


def test_sql_functions_unit_vectors(spark):
    register_sql_functions(spark, prefix="sw_")
    r = spark.sql(
        "SELECT sw_lifecycle_stage(0.25D, 0.21D, 0.44D, 0.78D), sw_lifecycle_stage(0.86D, -0.34D, -0.12D, 0.18D), "
        "sw_risk_score(-0.42D, -0.28D, 0.17D, 0.22D), sw_risk_score(0.08D, 0.11D, 0.02D, 0.03D), "
        "sw_opportunity_score(0.91D, -0.18D, 800L), sw_risk_bucket(100.0D), sw_risk_bucket(19.9D)"
    ).collect()[0]
    assert tuple(r) == ("growth", "decline", 100.0, 19.9, 86.76, "critical", "stable")
