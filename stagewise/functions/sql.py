"""The scoring rules as SQL functions, for users who write ``spark.sql``.

``register_sql_functions(spark)`` creates temporary SQL functions (bodies are
SQL expressions, inlined by the optimizer — no Python at run time):

* ``lifecycle_stage(age_ratio, revenue_change, sentiment, sell_through)``
* ``risk_score(sentiment_delta, revenue_change, return_rate, stockout_ratio)``
* ``opportunity_score(sentiment, revenue_change, review_count)``
* ``risk_bucket(score)``
* ``round_half_up(x, n)`` is not needed as a function: it is written inline.

The bodies use the same constants as :mod:`stagewise.functions.scoring`;
``tests/test_sql_functions.py`` checks both forms agree.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import constants as K
from .rounding import ROUND_NUDGE


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _rhu(expr: str, n: int) -> str:
    return f"(round(({expr}) + signum({expr}) * {_d(ROUND_NUDGE)}, {n}) + {_d(0.0)})"


def _clamp(expr: str) -> str:
    return f"greatest({_d(K.SCORE_MIN)}, least({_d(K.SCORE_MAX)}, {expr}))"


def _z(name: str) -> str:
    return f"coalesce({name}, {_d(0.0)})"


def definitions(prefix: str = "") -> dict[str, str]:
    a, rc, s, st = _z("age_ratio"), _z("revenue_change"), _z("sentiment"), _z("sell_through")
    stage = (
        f"CASE WHEN {a} < {_d(K.STAGE_INTRO_MAX_AGE_RATIO)} THEN 'introduction' "
        f"WHEN {rc} >= {_d(K.STAGE_GROWTH_MIN_REVENUE_CHANGE)} AND {s} >= {_d(K.STAGE_GROWTH_MIN_SENTIMENT)} "
        f"THEN 'growth' "
        f"WHEN {rc} >= {_d(K.STAGE_MATURITY_MIN_REVENUE_CHANGE)} AND {st} >= {_d(K.STAGE_MATURITY_MIN_SELL_THROUGH)} "
        f"THEN 'maturity' ELSE 'decline' END"
    )
    sd, rc2, rr, so = _z("sentiment_delta"), _z("revenue_change"), _z("return_rate"), _z("stockout_ratio")
    zero = _d(0.0)
    risk = _rhu(
        _clamp(
            f"{_d(K.RISK_BASE)} + greatest({zero}, -{sd}) * {_d(K.RISK_W_SENTIMENT_DROP)}"
            f" + greatest({zero}, -{rc2}) * {_d(K.RISK_W_REVENUE_DROP)}"
            f" + {rr} * {_d(K.RISK_W_RETURN_RATE)} + {so} * {_d(K.RISK_W_STOCKOUT)}"
            f" - greatest({zero}, {rc2}) * {_d(K.RISK_W_REVENUE_GAIN)}"
        ),
        2,
    )
    s3, rc3 = _z("sentiment"), _z("revenue_change")
    opp = _rhu(
        _clamp(
            f"{_d(K.OPP_BASE)} + greatest({zero}, {s3}) * {_d(K.OPP_W_SENTIMENT)}"
            f" + greatest({zero}, {_d(K.OPP_REVENUE_PIVOT)} - {rc3}) * {_d(K.OPP_W_REVENUE)}"
            f" + least(coalesce(review_count, 0L), {K.OPP_REVIEW_CAP}L) / {_d(K.OPP_REVIEW_DIVISOR)}"
        ),
        2,
    )
    score = _z("score")
    bucket = (
        f"CASE WHEN {score} >= {_d(K.BUCKET_CRITICAL_MIN)} THEN 'critical' "
        f"WHEN {score} >= {_d(K.BUCKET_WATCH_MIN)} THEN 'watch' ELSE 'stable' END"
    )
    p = prefix
    return {
        f"{p}lifecycle_stage": (
            "(age_ratio DOUBLE, revenue_change DOUBLE, sentiment DOUBLE, sell_through DOUBLE) "
            f"RETURNS STRING RETURN {stage}"
        ),
        f"{p}risk_score": (
            "(sentiment_delta DOUBLE, revenue_change DOUBLE, return_rate DOUBLE, stockout_ratio DOUBLE) "
            f"RETURNS DOUBLE RETURN {risk}"
        ),
        f"{p}opportunity_score": (
            f"(sentiment DOUBLE, revenue_change DOUBLE, review_count BIGINT) RETURNS DOUBLE RETURN {opp}"
        ),
        f"{p}risk_bucket": f"(score DOUBLE) RETURNS STRING RETURN {bucket}",
    }


def register_sql_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the temporary SQL functions; returns their names."""
    names = []
    for name, body in definitions(prefix).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    return names
