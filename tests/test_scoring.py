"""Stage, score and bucket rules as native column expressions."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions import (
    age_stage,
    clamp_sentiment,
    lifecycle_stage,
    opportunity_score,
    rating_from_sentiment,
    risk_bucket,
    risk_score,
    round_half_up,
)

D = T.DoubleType()


def _eval(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


STAGE_SCHEMA = T.StructType([T.StructField(n, D) for n in ("a", "rc", "s", "st")])


def stage_of(spark, *rows):
    return _eval(spark, list(rows), STAGE_SCHEMA, lifecycle_stage("a", "rc", "s", "st"))


RISK_SCHEMA = T.StructType([T.StructField(n, D) for n in ("sd", "rc", "rr", "so")])


def risk_of(spark, *rows):
    return _eval(spark, list(rows), RISK_SCHEMA, risk_score("sd", "rc", "rr", "so"))


# --- the original unit vectors of the scoring rules -------------------------

def test_growth_vector(spark):
    assert stage_of(spark, (0.25, 0.21, 0.44, 0.78)) == ["growth"]


def test_decline_vector(spark):
    assert stage_of(spark, (0.86, -0.34, -0.12, 0.18)) == ["decline"]


def test_risk_bucket_vectors(spark):
    scores = risk_of(spark, (-0.42, -0.28, 0.17, 0.22), (0.08, 0.11, 0.02, 0.03))
    assert scores == [100.0, 19.9]  # 112.05 clamped; 19.9
    df = spark.createDataFrame([(s,) for s in scores], "x double")
    assert [r[0] for r in df.select(risk_bucket("x")).collect()] == ["critical", "stable"]


def test_opportunity_vector_bounded(spark):
    df = spark.createDataFrame([(0.91, -0.18, 800)], "s double, rc double, n long")
    (v,) = [r[0] for r in df.select(opportunity_score("s", "rc", "n")).collect()]
    assert 0.0 <= v <= 100.0
    assert v == 86.76


# --- thresholds at their boundaries ----------------------------------------

def test_stage_boundaries(spark):
    got = stage_of(
        spark,
        (0.1799, 0.5, 0.5, 0.9),   # just under the intro cut
        (0.18, 0.12, 0.15, 0.0),   # growth exactly at both bounds
        (0.18, 0.1199, 0.15, 0.42),  # not growth; maturity at sell-through bound
        (0.18, -0.18, 0.0, 0.42),  # maturity exactly at revenue bound
        (0.18, -0.1801, 0.0, 0.99),  # below maturity revenue bound -> decline
        (0.18, 0.5, 0.1499, 0.4199),  # neither
        (None, None, None, None),  # all null -> age 0 -> introduction
        (-0.5, 0.9, 0.9, 0.9),     # before launch -> introduction
    )
    assert got == ["introduction", "growth", "maturity", "maturity", "decline", "decline", "introduction",
                   "introduction"]


def test_risk_bucket_boundaries(spark):
    df = spark.createDataFrame([(75.0,), (74.99,), (55.0,), (54.99,), (None,)], "x double")
    assert [r[0] for r in df.select(risk_bucket("x")).collect()] == [
        "critical", "watch", "watch", "stable", "stable"]


def test_risk_nulls_default_to_zero(spark):
    assert risk_of(spark, (None, None, None, None)) == [18.0]


def test_scores_clamped(spark):
    assert risk_of(spark, (1.0, 5.0, 0.0, 0.0)) == [0.0]  # 18 - 75 -> 0
    df = spark.createDataFrame([(1.0, -5.0, 10_000)], "s double, rc double, n long")
    assert [r[0] for r in df.select(opportunity_score("s", "rc", "n")).collect()] == [100.0]


def test_age_stage_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.1999, 0.2, 0.4599, 0.46, 0.8199, 0.82, 3.0)], "a double")
    assert [r[0] for r in df.select(age_stage("a")).collect()] == [
        "introduction", "introduction", "growth", "growth", "maturity", "maturity", "decline", "decline"]


def test_rating_from_sentiment(spark):
    vals = [-1.0, -0.75, -0.5, 0.0, 0.25, 0.75, 1.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r[0] for r in df.select(rating_from_sentiment("s")).collect()]
    want = [max(1, min(5, int(round(((v + 1.0) / 2.0) * 4.0 + 1.0)))) for v in vals]
    assert got == want
    clamped = [r[0] for r in df.select(clamp_sentiment("s")).collect()]
    assert clamped == [max(-1.0, min(1.0, v)) for v in vals]


def test_round_half_up_ties_and_negative_zero(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.125,), (-0.0001,), (1.005,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got == [0.13, 2.68, -0.13, 0.0, 1.01]
    assert math.copysign(1.0, got[3]) == 1.0  # no -0.0


# --- invariants and hand-computed values -----------------------------------

finite = st.floats(min_value=-2.0, max_value=2.0, allow_nan=False, allow_infinity=False)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(finite, finite, st.floats(0, 1), st.floats(0, 1)), min_size=1, max_size=40))
def test_scores_stay_in_range_and_follow_their_inputs(spark, rows):
    df = spark.createDataFrame(rows, RISK_SCHEMA)
    out = df.select(
        risk_score("sd", "rc", "rr", "so").alias("risk"),
        risk_score("sd", "rc", F.col("rr") + 0.1, "so").alias("more_returns"),
        opportunity_score("sd", "rc", F.lit(37)).alias("opp"),
        opportunity_score(F.col("sd") + 0.1, "rc", F.lit(37)).alias("better_sentiment"),
    ).collect()
    for r in out:
        assert 0.0 <= r.risk <= r.more_returns <= 100.0 and 0.0 <= r.opp <= r.better_sentiment <= 100.0


@pytest.mark.parametrize("score,bucket", [(80.0, "critical"), (60.0, "watch"), (10.0, "stable"), (None, "stable")])
def test_buckets(spark, score, bucket):
    assert _eval(spark, [(score,)], T.StructType([T.StructField("s", D)]), risk_bucket("s")) == [bucket]
