"""The seven summary tables derived from ``monthly_metrics`` (M1..M7).

"Current" means the latest month over all products (a scalar subquery, no
driver round trip), of the table itself or given as ``latest``. Every mart is an aggregate or projection of the fact
table, so each is one partial+final aggregation over data that is already
one row per (product, month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import is_at_risk, money_avg, money_sum, round_half_up
from ..schemas import MARTS, conform
from .monthly import current_rows


def _avg(col: str, scale: int) -> F.Column:
    return round_half_up(F.avg(F.col(col).cast("double")), scale)


def _at_risk_count() -> F.Column:
    return F.count_if(is_at_risk("risk_score")).cast("int")


def dashboard_overview(monthly: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """M1: one row, even when the table is empty."""
    cur = current_rows(monthly, latest)
    out = cur.agg(
        F.max("month").alias("latest_month"),
        F.count_distinct("product_id").cast("int").alias("active_products"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        money_sum("revenue").alias("revenue"),
        _avg("avg_rating", 3).alias("avg_rating"),
        _avg("avg_sentiment", 4).alias("avg_sentiment"),
        _at_risk_count().alias("at_risk_products"),
    )
    return conform(out, MARTS["dashboard_overview"])


def monthly_trends(monthly: DataFrame) -> DataFrame:
    """M2: revenue, units and mean of per-product means, by month."""
    out = monthly.groupBy("month").agg(
        money_sum("revenue").alias("revenue"),
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        _avg("avg_rating", 3).alias("avg_rating"),
        _avg("avg_sentiment", 4).alias("avg_sentiment"),
    )
    return conform(out, MARTS["monthly_trends"])


def stage_sentiment(monthly: DataFrame) -> DataFrame:
    """M3: by (month, lifecycle stage)."""
    out = monthly.groupBy("month", "lifecycle_stage").agg(
        _avg("avg_sentiment", 4).alias("avg_sentiment"),
        _avg("avg_rating", 3).alias("avg_rating"),
        F.sum("review_count").cast("bigint").alias("review_count"),
        money_sum("revenue").alias("revenue"),
    )
    return conform(out, MARTS["stage_sentiment"])


def category_health(monthly: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """M4: current month by category (NULL category is its own group)."""
    out = current_rows(monthly, latest).groupBy("category").agg(
        F.count_distinct("product_id").cast("int").alias("active_products"),
        money_sum("revenue").alias("revenue"),
        _avg("avg_sentiment", 4).alias("avg_sentiment"),
        _avg("revenue_change", 4).alias("revenue_change"),
        _avg("return_rate", 4).alias("return_rate"),
        _at_risk_count().alias("at_risk_products"),
    )
    return conform(out, MARTS["category_health"])


def lifecycle_distribution(monthly: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """M5: current month by lifecycle stage."""
    out = current_rows(monthly, latest).groupBy("lifecycle_stage").agg(
        F.count_distinct("product_id").cast("int").alias("product_count"),
        _avg("age_days", 2).alias("avg_age_days"),
        money_avg("revenue").alias("avg_revenue"),
        _avg("avg_sentiment", 4).alias("avg_sentiment"),
    )
    return conform(out, MARTS["lifecycle_distribution"])


def _rounded_columns() -> dict[str, F.Column]:
    return {
        "risk_score": round_half_up("risk_score", 2),
        "opportunity_score": round_half_up("opportunity_score", 2),
        "revenue": round_half_up("revenue", 2),
        "revenue_change": round_half_up("revenue_change", 4),
        "sentiment_delta": round_half_up("sentiment_delta", 4),
        "return_rate": round_half_up("return_rate", 4),
        "stockout_ratio": round_half_up("stockout_ratio", 4),
        "avg_sentiment": round_half_up("avg_sentiment", 4),
        "avg_rating": round_half_up("avg_rating", 3),
        "age_days": F.col("age_days").cast("double"),
    }


def _project(df: DataFrame, mart: str) -> DataFrame:
    rounded = _rounded_columns()
    schema = MARTS[mart]
    return df.select(
        *[(rounded[f.name] if f.name in rounded else F.col(f.name)).cast(f.dataType).alias(f.name)
          for f in schema.fields]
    )


def risk_order() -> list[F.Column]:
    """Risk desc, revenue desc, then product id (a total order within a month)."""
    return [
        F.col("risk_score").desc_nulls_last(),
        F.col("revenue").desc_nulls_last(),
        F.col("product_id").asc_nulls_first(),
    ]


def product_risk_scores(monthly: DataFrame, limit: int = K.TOP_RISK_LIMIT, latest: DataFrame | None = None) -> DataFrame:
    """M6: current month's top products by risk (ties: revenue, product id).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``limit`` rows, only those reach the final merge.
    """
    return _project(current_rows(monthly, latest), "product_risk_scores").orderBy(*risk_order()).limit(limit)


def product_stage_history(monthly: DataFrame) -> DataFrame:
    """M7: every product-month with rounded measures (kept as a table)."""
    return _project(monthly, "product_stage_history")


MART_BUILDERS = {
    "dashboard_overview": dashboard_overview,
    "monthly_trends": monthly_trends,
    "stage_sentiment": stage_sentiment,
    "category_health": category_health,
    "lifecycle_distribution": lifecycle_distribution,
    "product_risk_scores": product_risk_scores,
    "product_stage_history": product_stage_history,
}


def build_marts(monthly: DataFrame) -> dict[str, DataFrame]:
    return {name: build(monthly) for name, build in MART_BUILDERS.items()}
