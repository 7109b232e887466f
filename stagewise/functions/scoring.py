"""Lifecycle stage, risk and opportunity scores as native column expressions.

All of these stay inside whole-stage codegen (no Python UDF). Every input is
null-defaulted to 0 the way the scoring rules define it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .rounding import _c, clamp, round_half_up


def _z(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(0.0))


def _pos(col: Column) -> Column:
    return F.greatest(F.lit(0.0), col)


def lifecycle_stage(
    age_ratio: Column | str,
    revenue_change: Column | str,
    sentiment: Column | str,
    sell_through: Column | str,
) -> Column:
    """Ordered stage rules (first match wins)."""
    a, rc, s, st = _z(age_ratio), _z(revenue_change), _z(sentiment), _z(sell_through)
    return (
        F.when(a < F.lit(K.STAGE_INTRO_MAX_AGE_RATIO), F.lit("introduction"))
        .when(
            (rc >= F.lit(K.STAGE_GROWTH_MIN_REVENUE_CHANGE)) & (s >= F.lit(K.STAGE_GROWTH_MIN_SENTIMENT)),
            F.lit("growth"),
        )
        .when(
            (rc >= F.lit(K.STAGE_MATURITY_MIN_REVENUE_CHANGE)) & (st >= F.lit(K.STAGE_MATURITY_MIN_SELL_THROUGH)),
            F.lit("maturity"),
        )
        .otherwise(F.lit("decline"))
    )


def risk_score(
    sentiment_delta: Column | str,
    revenue_change: Column | str,
    return_rate: Column | str,
    stockout_ratio: Column | str,
) -> Column:
    """Weighted risk signal, clamped to 0..100 and rounded to 2 dp.

    Terms are added left to right so the double result is reproducible.
    """
    sd, rc, rr, so = _z(sentiment_delta), _z(revenue_change), _z(return_rate), _z(stockout_ratio)
    score = (
        F.lit(K.RISK_BASE)
        + _pos(-sd) * F.lit(K.RISK_W_SENTIMENT_DROP)
        + _pos(-rc) * F.lit(K.RISK_W_REVENUE_DROP)
        + rr * F.lit(K.RISK_W_RETURN_RATE)
        + so * F.lit(K.RISK_W_STOCKOUT)
        - _pos(rc) * F.lit(K.RISK_W_REVENUE_GAIN)
    )
    return round_half_up(clamp(score, K.SCORE_MIN, K.SCORE_MAX), 2)


def opportunity_score(
    sentiment: Column | str,
    revenue_change: Column | str,
    review_count: Column | str,
) -> Column:
    s, rc = _z(sentiment), _z(revenue_change)
    reviews = F.coalesce(_c(review_count).cast("bigint"), F.lit(0).cast("bigint"))
    score = (
        F.lit(K.OPP_BASE)
        + _pos(s) * F.lit(K.OPP_W_SENTIMENT)
        + _pos(F.lit(K.OPP_REVENUE_PIVOT) - rc) * F.lit(K.OPP_W_REVENUE)
        + F.least(reviews, F.lit(K.OPP_REVIEW_CAP).cast("bigint")) / F.lit(K.OPP_REVIEW_DIVISOR)
    )
    return round_half_up(clamp(score, K.SCORE_MIN, K.SCORE_MAX), 2)


def risk_bucket(score: Column | str) -> Column:
    s = _z(score)
    return (
        F.when(s >= F.lit(K.BUCKET_CRITICAL_MIN), F.lit("critical"))
        .when(s >= F.lit(K.BUCKET_WATCH_MIN), F.lit("watch"))
        .otherwise(F.lit("stable"))
    )


def is_at_risk(score: Column | str) -> Column:
    return _c(score) >= F.lit(K.AT_RISK_MIN)


def age_stage(age_ratio: Column | str) -> Column:
    """Stage implied by age alone (used for catalogue planning)."""
    a = _c(age_ratio)
    intro, growth, maturity = K.AGE_STAGE_BOUNDS
    return (
        F.when(a < F.lit(intro), F.lit("introduction"))
        .when(a < F.lit(growth), F.lit("growth"))
        .when(a < F.lit(maturity), F.lit("maturity"))
        .otherwise(F.lit("decline"))
    )


def clamp_sentiment(sentiment: Column | str) -> Column:
    """Sentiment limited to [-1, 1] at 3 dp (half-even)."""
    return F.bround(clamp(_c(sentiment).cast("double"), -1.0, 1.0), 3)


def rating_from_sentiment(sentiment: Column | str) -> Column:
    """1..5 star rating implied by a [-1, 1] sentiment (half-even rounding)."""
    s = _c(sentiment).cast("double")
    raw = F.bround((s + F.lit(1.0)) / F.lit(2.0) * F.lit(4.0) + F.lit(1.0), 0).cast("int")
    return F.greatest(F.lit(1), F.least(F.lit(5), raw))
