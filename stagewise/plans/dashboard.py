"""Dashboard datasets from stored marts (what a dashboard reads).

The marts are read back (Parquet or JDBC) and the dashboard datasets are
derived from them, so serving a dashboard never touches raw data.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import insights
from ..schemas import MARTS
from ..sinks.jdbc import table_exists
from ..sinks.writers import mart_order, read_mart
from ..sources.raw_zone import raw_zone_inventory


def load_marts(
    spark: SparkSession,
    root: str | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """All seven marts, from Parquet under ``root`` or from a JDBC database.

    A mart that does not exist (yet) comes back empty with its declared
    schema, so the dashboard shows an empty section instead of failing.
    """
    if not jdbc_url and root is None:
        raise ValueError("give root or jdbc_url")
    out = {}
    for name, schema in MARTS.items():
        out[name] = _read_or_empty(spark, name, schema, root, jdbc_url, jdbc_properties)
    return out


def _read_or_empty(spark, name, schema, root, jdbc_url, jdbc_properties) -> DataFrame:
    if jdbc_url:
        props = jdbc_properties or {}
        if not table_exists(spark, jdbc_url, name, props):  # a database that can't be reached raises
            return spark.createDataFrame([], schema)
        return spark.read.jdbc(jdbc_url, name, properties=props)
    try:
        return read_mart(spark, root, name, ordered=False)
    except AnalysisException:  # path does not exist
        return spark.createDataFrame([], schema)


def _overview(marts: dict[str, DataFrame]) -> DataFrame:
    # One overview row is shown (after append runs the table can hold more).
    return marts["dashboard_overview"].limit(1)


def dashboard_sections(
    marts: dict[str, DataFrame], raw_root: str | None = None, positioned: bool = False
) -> dict[str, DataFrame]:
    """All dashboard datasets; with ``raw_root`` also the raw-zone inventory.

    ``positioned`` adds ``_position`` to each section: the list order a
    dashboard shows (the marts' reading order, the alert/transition/option
    order; 1 for single-row sections).
    """
    history = marts["product_stage_history"]
    risk = marts["product_risk_scores"]

    def listed(name: str, df: DataFrame) -> DataFrame:
        if not positioned:
            return df
        order = mart_order(name)
        return insights.with_position(df, order) if order else df.withColumn("_position", F.lit(1))

    def single(df: DataFrame) -> DataFrame:
        return df.withColumn("_position", F.lit(1)) if positioned else df

    sections = {
        "overview": listed("dashboard_overview", _overview(marts)),
        "monthly_trends": listed("monthly_trends", marts["monthly_trends"]),
        "stage_sentiment": listed("stage_sentiment", marts["stage_sentiment"]),
        "category_health": listed("category_health", marts["category_health"]),
        "lifecycle_distribution": listed("lifecycle_distribution", marts["lifecycle_distribution"]),
        "product_risk_scores": listed("product_risk_scores", risk),
        "alerts": insights.alerts(risk, positioned=positioned),
        "stage_transitions": insights.stage_transitions(history, positioned=positioned),
        "filter_options": insights.filter_options(history, risk, positioned=positioned),
        "project_summary": single(insights.project_summary(history)),
    }
    if raw_root:
        sections["raw_zone"] = single(raw_zone_inventory(history.sparkSession, raw_root))
    return sections


def dashboard_payload(marts: dict[str, DataFrame], raw_root: str | None = None) -> DataFrame:
    """``(section, position, row_json)`` rows of the dashboard, from marts."""
    return insights.dashboard_payload(dashboard_sections(marts, raw_root, positioned=True))


def summary_report(marts: dict[str, DataFrame]) -> DataFrame:
    """Report lines (overview header + top risks) from stored marts."""
    return insights.summary_report(_overview(marts), marts["product_risk_scores"])
