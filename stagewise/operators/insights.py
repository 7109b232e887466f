"""Dashboard datasets derived from the marts (M8..M13). All are
DataFrames; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import fixed, iso_date, percent, thousands
from .marts import risk_order


def with_position(df: DataFrame, order: list[F.Column]) -> DataFrame:
    """Add ``_position`` (1, 2, ...) in ``order``.

    Only used on bounded dashboard sections (top-k outputs, marts with one row
    per month, category or stage), so one ordering window per section is small.
    """
    return df.withColumn("_position", F.row_number().over(Window.orderBy(*order)))


def _present(col: str) -> F.Column:
    """Python truthiness of a text/date value: not NULL and not empty."""
    c = F.col(col)
    return c.isNotNull() & (c.cast("string") != F.lit(""))


# --- M8: stage transitions -------------------------------------------------

def stage_transitions(history: DataFrame, limit: int = K.TRANSITION_LIMIT, positioned: bool = False) -> DataFrame:
    """Most frequent (previous stage -> stage) pairs of consecutive rows per
    product, including self-transitions.

    Ties on the count go to the pair seen first when products are taken in
    order of (first month, product id) and months in order; that is the
    smallest ``(first_month, product_id, month)`` among its occurrences.
    The window is per product, so its groups are bounded by months.
    """
    ordered = Window.partitionBy("product_id").orderBy("month")
    whole = Window.partitionBy("product_id")
    pairs = history.select(
        "product_id",
        "month",
        F.lag("lifecycle_stage").over(ordered).alias("from_stage"),
        F.col("lifecycle_stage").alias("to_stage"),
        F.row_number().over(ordered).alias("_n"),
        F.min("month").over(whole).alias("_first_month"),
    ).filter(F.col("_n") > 1)
    counted = pairs.groupBy("from_stage", "to_stage").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.min(F.struct("_first_month", "product_id", "month")).alias("_first_seen"),
    )
    order = [F.col("product_count").desc(), F.col("_first_seen").asc()]
    top = counted.orderBy(*order).limit(limit)
    if positioned:
        return with_position(top, order).select("from_stage", "to_stage", "product_count", "_position")
    return top.select("from_stage", "to_stage", "product_count")


# --- M9: alerts -------------------------------------------------------------

def alerts(
    risk_scores: DataFrame,
    limit: int = K.ALERT_LIMIT,
    unknown_category: str = K.UNKNOWN_CATEGORY,
    positioned: bool = False,
) -> DataFrame:
    """First-match alert rules over the top-risk table, first ``limit`` in
    risk order: risk >= 70 (high from 80), else return rate >= 25%, else
    sentiment delta <= -0.15."""
    rs = F.coalesce(F.col("risk_score"), F.lit(0.0))
    rr = F.coalesce(F.col("return_rate"), F.lit(0.0))
    sd = F.coalesce(F.col("sentiment_delta"), F.lit(0.0))
    risk_rule = rs >= F.lit(K.ALERT_RISK_MIN)
    return_rule = rr >= F.lit(K.ALERT_RETURN_RATE_MIN)
    sentiment_rule = sd <= F.lit(K.ALERT_SENTIMENT_DELTA_MAX)
    sep = F.lit(" · ")
    category = F.coalesce(F.col("category"), F.lit(unknown_category))
    stage = F.coalesce(F.col("lifecycle_stage"), F.lit("stage"))
    month = F.coalesce(iso_date("month"), F.lit("None"))
    metric = F.when(_present("product_name"), F.col("product_name")).otherwise(F.col("product_id"))

    title = (
        F.when(risk_rule, F.lit(K.ALERT_TITLE_RISK))
        .when(return_rule, F.lit(K.ALERT_TITLE_RETURNS))
        .when(sentiment_rule, F.lit(K.ALERT_TITLE_SENTIMENT))
    )
    severity = (
        F.when(risk_rule, F.when(rs >= F.lit(K.ALERT_RISK_HIGH_MIN), F.lit("high")).otherwise(F.lit("medium")))
        .when(return_rule, F.lit("medium"))
        .when(sentiment_rule, F.lit("low"))
    )
    detail = (
        F.when(risk_rule, F.concat(category, sep, stage, sep, F.lit("Risk "), fixed(rs, 1), F.lit(" in "), month))
        .when(return_rule, F.concat(F.lit("Return rate "), percent(rr, 1), sep, category, sep, month))
        .when(sentiment_rule, F.concat(F.lit("Sentiment Δ "), fixed(sd, 3), sep, category, sep, month))
    )
    top = (
        risk_scores.select(
            title.alias("title"), metric.alias("metric"), severity.alias("severity"), detail.alias("detail"),
            "risk_score", "revenue", "product_id",
        )
        .filter(F.col("title").isNotNull())
        .orderBy(*risk_order())
        .limit(limit)
    )
    cols = ["title", "metric", "severity", "detail"]
    if positioned:
        return with_position(top, risk_order()).select(*cols, "_position")
    return top.select(*cols)


# --- M10: filter options ----------------------------------------------------

def filter_options(history: DataFrame, risk_scores: DataFrame, positioned: bool = False) -> DataFrame:
    """Long form ``(option, value)``: months (newest first), categories,
    brands, lifecycle stages, risk buckets, and the default month.

    Months, categories and brands come from one pass over the history
    (each row yields its three option values, then one distinct); the default
    month is the largest month of that same distinct result.
    """
    spark = history.sparkSession
    pairs = history.select(
        F.explode(
            F.array(
                F.struct(F.lit("months").alias("option"), iso_date("month").alias("value")),
                F.struct(F.lit("categories").alias("option"), F.col("category").cast("string").alias("value")),
                F.struct(F.lit("brands").alias("option"), F.col("brand").cast("string").alias("value")),
            )
        ).alias("o")
    ).select("o.option", "o.value")
    from_history = pairs.filter(_present("value")).distinct()
    # ISO dates order as text, so the newest month is the largest value.
    default = from_history.filter(F.col("option") == "months").agg(F.max("value").alias("value")).select(
        F.lit("default_month").alias("option"), "value"
    )
    buckets = (
        risk_scores.filter(_present("risk_bucket"))
        .select(F.lit("risk_buckets").alias("option"), F.col("risk_bucket").cast("string").alias("value"))
        .distinct()
    )
    stages = spark.range(1).select(
        F.lit("lifecycle_stages").alias("option"), F.explode(F.array(*[F.lit(s) for s in K.STAGES])).alias("value")
    )
    out = from_history.unionByName(stages).unionByName(buckets).unionByName(default)
    option_rank = F.array_position(
        F.array(*[F.lit(o) for o in ("months", "categories", "brands", "lifecycle_stages", "risk_buckets",
                                      "default_month")]),
        F.col("option"),
    )
    stage_rank = F.array_position(F.array(*[F.lit(s) for s in K.STAGES]), F.col("value"))
    order = [
        option_rank,
        F.when(F.col("option") == "months", F.col("value")).desc(),
        F.when(F.col("option") == "lifecycle_stages", stage_rank),
        F.col("value"),
    ]
    if positioned:
        return with_position(out, order)
    return out.orderBy(*order)


# --- M11: project summary ---------------------------------------------------

def project_summary(history: DataFrame) -> DataFrame:
    """Distinct products and months in the stage history (one row)."""
    return history.agg(
        F.count_distinct(F.when(_present("product_id"), F.col("product_id"))).alias("product_count"),
        F.count_distinct(F.col("month")).alias("month_count"),
    )


# --- M13: summary report ----------------------------------------------------

def summary_report(
    overview: DataFrame,
    risk_scores: DataFrame,
    limit: int = K.SUMMARY_TOP_RISK_LIMIT,
    unknown_product: str = K.UNKNOWN_PRODUCT,
) -> DataFrame:
    """Report lines ``(line_no, line)``: overview header, then the top
    ``limit`` risks as ``name | Risk x | Returns y% | Sentiment Δ z``."""
    header = overview.select(
        F.posexplode(
            F.array(
                F.concat(F.lit("Latest month: "), F.coalesce(iso_date("latest_month"), F.lit("N/A"))),
                F.concat(F.lit("Active products: "), F.coalesce(F.col("active_products"), F.lit(0)).cast("string")),
                F.concat(F.lit("Revenue: "), thousands(F.coalesce(F.col("revenue"), F.lit(0.0)))),
                F.concat(F.lit("Avg sentiment: "), fixed(F.coalesce(F.col("avg_sentiment"), F.lit(0.0)), 3)),
                F.lit("Top Risk Products"),
            )
        ).alias("pos", "line")
    ).select((F.col("pos") + 1).cast("int").alias("line_no"), "line")
    # ``risk_scores`` is the top-25 table, so this global ordering window
    # covers at most ``limit`` rows.
    top = risk_scores.orderBy(*risk_order()).limit(limit)
    rank = F.row_number().over(Window.orderBy(*risk_order()))
    sep = F.lit(" | ")
    items = top.select(
        (F.lit(5) + rank).cast("int").alias("line_no"),
        F.concat(
            F.coalesce(F.col("product_name"), F.lit(unknown_product)), sep,
            F.lit("Risk "), fixed(F.coalesce(F.col("risk_score"), F.lit(0.0)), 1), sep,
            F.lit("Returns "), percent(F.coalesce(F.col("return_rate"), F.lit(0.0)), 1), sep,
            F.lit("Sentiment Δ "), fixed(F.coalesce(F.col("sentiment_delta"), F.lit(0.0)), 3),
        ).alias("line"),
    )
    return header.unionByName(items)


# --- M12: dashboard payload -------------------------------------------------

PAYLOAD_SECTIONS = (
    "overview", "monthly_trends", "stage_sentiment", "category_health", "lifecycle_distribution",
    "product_risk_scores", "alerts", "stage_transitions", "filter_options", "project_summary", "raw_zone",
)


def dashboard_payload(sections: dict[str, DataFrame]) -> DataFrame:
    """``(section, position, row_json)`` rows for the bounded dashboard
    sections plus a ``ready`` row (true when the overview table has a row).

    A section that carries ``_position`` keeps it (its list order); other
    sections have NULL positions. Dates serialise as ISO ``yyyy-MM-dd``;
    DECIMAL and DOUBLE as JSON numbers; NULL as ``null`` (fields are kept). The full stage history is not part of
    the payload: it stays a table.
    """
    parts = []
    for name in PAYLOAD_SECTIONS:
        if name not in sections:
            continue
        df = sections[name]
        fields = [F.col(c) for c in df.columns if c != "_position"]
        position = F.col("_position") if "_position" in df.columns else F.lit(None)
        parts.append(
            df.select(
                F.lit(name).alias("section"),
                position.cast("int").alias("position"),
                F.to_json(F.struct(*fields), {"dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"})
                .alias("row_json"),
            )
        )
    overview = sections["overview"]
    ready = overview.agg(
        F.to_json(F.struct((F.count(F.lit(1)) > 0).alias("ready"))).alias("row_json")
    ).select(F.lit("ready").alias("section"), F.lit(1).alias("position"), "row_json")
    out = ready
    for p in parts:
        out = out.unionByName(p)
    return out
