"""Registered queries: one per operator/dataset, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the driver's parquet tables mapped by ``sources.adapters``; JSON
source queries first write those datasets as a raw zone (shared scratch
folder) and read them back through the raw readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    age_stage,
    clamp_sentiment,
    is_launched,
    month_end,
    month_key,
    rating_from_sentiment,
    shift_months,
)
from ..operators import insights, mart_states, marts, monthly, quality
from ..session import scratch_path
from ..sinks.writers import write_jsonl
from ..sources import adapters, jsonl, raw_zone, rejects, zone_map

Query = Callable[[SparkSession, str], DataFrame]


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return adapters.datasets(spark, sf_dir)


def m0(spark: SparkSession, sf_dir: str, fused: bool = True) -> DataFrame:
    d = inputs(spark, sf_dir)
    return monthly.monthly_metrics(d["products"], d["orders"], d["reviews"], d["inventory"], fused=fused)


def stored_m0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table, written once to shared scratch: what reads it twice (current month, several marts) scans it."""
    path = scratch_path(spark, "fact")
    metrics = m0(spark, sf_dir)
    metrics.write.parquet(path)
    return spark.read.schema(metrics.schema).parquet(path)


def with_latest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The fact table and its latest month, which comes from the sources' date columns: one pass, nothing stored."""
    d = inputs(spark, sf_dir)
    return m0(spark, sf_dir), monthly.latest_activity_month(d["orders"], d["reviews"], d["inventory"])


def _current(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(*with_latest(spark, sf_dir))


def _history(spark, sf_dir):
    return marts.product_stage_history(m0(spark, sf_dir))


def _risk(spark, sf_dir):
    metrics, latest = with_latest(spark, sf_dir)
    return marts.product_risk_scores(metrics, latest=latest)


# --- raw zone round trip -----------------------------------------------------

_TS = {"products": None, "orders": "order_ts", "reviews": "review_ts", "inventory": "snapshot_date"}


def write_raw_zone(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """K7: the four datasets as a JSON-lines raw zone; returns its root."""
    root = root or scratch_path(spark, "raw-zone")
    for name, df in inputs(spark, sf_dir).items():
        write_jsonl(df, f"{root}/{name}", _TS[name])
    return root


def _roundtrip(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, f"raw-{name}")
        write_jsonl(inputs(spark, sf_dir)[name], f"{root}/{name}", _TS[name])
        return jsonl.read_dataset(spark, root, name)

    return run


def src_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.orders_monthly(_roundtrip("orders")(spark, sf_dir))


def src_orders_latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9: the newest month, named by the zone map, from the files that can hold it."""
    root = scratch_path(spark, "raw-zoned")
    write_jsonl(inputs(spark, sf_dir)["orders"], f"{root}/orders", _TS["orders"])
    zone_map.update_map(spark, root, "orders")
    latest = zone_map.last_month(spark, root)
    return monthly.orders_monthly(zone_map.read_zoned(spark, root, "orders", latest, latest))


# --- scalar operators ---------------------------------------------------------

def q_month_key(spark, sf_dir):
    s = inputs(spark, sf_dir)["orders"]
    m = month_key("order_ts")
    return (
        s.select(m.alias("month"))
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .select(
            "month",
            month_end("month").alias("month_end"),
            shift_months("month", 1).alias("next_month"),
            shift_months("month", -1).alias("prev_month"),
            "order_count",
        )
    )


def q_net_revenue(spark, sf_dir):
    s = inputs(spark, sf_dir)["orders"]
    return s.groupBy("product_id").agg(
        F.round(F.sum(monthly.net_revenue()), 2).cast("double").alias("net_revenue")
    )


def _m0_cols(*cols: str) -> Query:
    return lambda spark, sf_dir: m0(spark, sf_dir).select(*cols)


def q_age_stage(spark, sf_dir):
    return (
        m0(spark, sf_dir)
        .filter(F.col("age_ratio").isNotNull())
        .select("product_id", "month", age_stage("age_ratio").alias("age_stage"))
    )


def q_rating_from_sentiment(spark, sf_dir):
    r = inputs(spark, sf_dir)["reviews"]
    return r.select(
        "product_id",
        "review_ts",
        "sentiment_score",
        clamp_sentiment("sentiment_score").alias("clamped_sentiment"),
        rating_from_sentiment("sentiment_score").alias("implied_rating"),
    )


def q_launched_products(spark, sf_dir):
    return (
        m0(spark, sf_dir)
        .filter(is_launched("launch_date", "month"))
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("launched_products"),
            F.sum(F.datediff(month_end("month"), "launch_date")).cast("bigint").alias("total_age_days"),
        )
    )


# --- aggregates / joins -------------------------------------------------------

def _per_source(fn, name):
    return lambda spark, sf_dir: fn(inputs(spark, sf_dir)[name])


def q_activity_months(spark, sf_dir, d=None):
    d = d or inputs(spark, sf_dir)
    return monthly.activity_months(
        monthly.orders_monthly(d["orders"]), monthly.reviews_monthly(d["reviews"]),
        monthly.inventory_monthly(d["inventory"]),
    )


def q_activity_with_catalog(spark, sf_dir):
    d = inputs(spark, sf_dir)
    act = q_activity_months(spark, sf_dir, d)
    return act.join(monthly.catalog(d["products"]), "product_id", "left")


def q_monthly_joined(spark, sf_dir):
    d = inputs(spark, sf_dir)
    return monthly.monthly_joined(d["products"], d["orders"], d["reviews"], d["inventory"])


def q_monthly_fused(spark, sf_dir):
    d = inputs(spark, sf_dir)
    return monthly.monthly_fused(d["products"], d["orders"], d["reviews"], d["inventory"])


def _refreshed_state(spark, sf_dir) -> str:
    """The raw zone arrives in two parts; the second refresh adds to months of the first and opens new ones."""
    from ..streaming.touched import refresh_touched

    raw, state = scratch_path(spark, "raw-zone"), scratch_path(spark, "refresh-state")
    for late in (False, True):
        for name, df in inputs(spark, sf_dir).items():
            ts = _TS[name]
            if ts is None:
                if not late:
                    write_jsonl(df, f"{raw}/{name}", codec="gzip")
                continue
            part = F.coalesce(F.pmod(F.xxhash64(ts), F.lit(8)) == 0, F.lit(False))  # an eighth of the days is late
            write_jsonl(df.where(part == F.lit(late)), f"{raw}/{name}", ts, mode="append", codec="gzip")
        refresh_touched(spark, raw, state, buckets=8)
    return state


def q_incremental_refresh(spark, sf_dir):
    from ..streaming.touched import read_state_fact

    return read_state_fact(spark, _refreshed_state(spark, sf_dir))


def q_refreshed_category_health(spark, sf_dir):
    """M4 after the two refreshes, merged from the stored states of the buckets."""
    from ..streaming.touched import read_state_marts

    return read_state_marts(spark, _refreshed_state(spark, sf_dir))["category_health"]


#: Buckets of products whose states are merged by the queries below.
STATE_BUCKETS = 64


def _by_month(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(mart_states.group_states(m0(spark, sf_dir), STATE_BUCKETS))


def q_risk_scores_by_month(spark, sf_dir):
    return mart_states.risk_scores_by_month(mart_states.top_states(m0(spark, sf_dir), STATE_BUCKETS))


def q_raw_rejects(spark, sf_dir):
    """A sales feed some of whose lines have a code in the place of a value: what the typed scan rejects."""
    code = {"order_ts": "concat(l_returnflag, '-', l_linestatus)", "quantity": "l_returnflag", "discount_pct": "l_linestatus",
            "returned_flag": "concat('maybe ', l_returnflag)"}
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    feed = lines.selectExpr(
        f"{adapters._pid('l_partkey')} AS product_id",
        *[f"CASE WHEN l_linenumber = {k} THEN {code[c]} ELSE {good} END AS {c}" for k, (c, good) in enumerate({
            "order_ts": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\")", "quantity": "cast(cast(l_quantity as int) as string)",
            "discount_pct": "cast(l_discount as string)", "returned_flag": "cast(l_returnflag = 'R' as string)"}.items(), 1)],
        "cast(l_extendedprice as string) AS unit_price",
    )
    raw, out = scratch_path(spark, "feed"), scratch_path(spark, "split")
    write_jsonl(feed, f"{raw}/orders")
    rejects.split_dataset(spark, raw, "orders", out)
    return rejects.reject_counts(rejects.read_rejects(spark, out, "orders"))


def q_payload(spark, sf_dir):
    from .dashboard import dashboard_payload

    return dashboard_payload(marts.build_marts(stored_m0(spark, sf_dir)))


def q_filter_options(spark, sf_dir):
    metrics = stored_m0(spark, sf_dir)
    return insights.filter_options(marts.product_stage_history(metrics), marts.product_risk_scores(metrics))


def q_summary_top_risk(spark, sf_dir):
    metrics = stored_m0(spark, sf_dir)
    return insights.summary_report(marts.dashboard_overview(metrics), marts.product_risk_scores(metrics))


def q_raw_zone_inventory(spark, sf_dir):
    return raw_zone.raw_zone_inventory(spark, sf_dir, "*.parquet")


QUERIES: dict[str, Query] = {
    # sources
    "src_products": _roundtrip("products"),
    "src_orders": _roundtrip("orders"),
    "src_reviews": _roundtrip("reviews"),
    "src_inventory": _roundtrip("inventory"),
    "src_json_roundtrip": src_json_roundtrip,
    "src_orders_latest_month": src_orders_latest_month,
    "raw_zone_inventory": q_raw_zone_inventory,
    # scalar operators
    "month_key": q_month_key,
    "net_revenue": q_net_revenue,
    "return_rate": _m0_cols("product_id", "month", "order_count", "returned_orders", "return_rate"),
    "revenue_change": _m0_cols("product_id", "month", "revenue", "revenue_change"),
    "sentiment_delta": _m0_cols("product_id", "month", "avg_sentiment", "sentiment_delta"),
    "stockout_ratio": _m0_cols("product_id", "month", "avg_stockout_hours", "stockout_ratio"),
    "product_age": _m0_cols("product_id", "month", "launch_date", "age_days", "age_ratio"),
    "lifecycle_stage": _m0_cols("product_id", "month", "lifecycle_stage"),
    "risk_score": _m0_cols("product_id", "month", "risk_score"),
    "risk_bucket": _m0_cols("product_id", "month", "risk_score", "risk_bucket"),
    "opportunity_score": _m0_cols("product_id", "month", "opportunity_score"),
    "age_stage": q_age_stage,
    "rating_from_sentiment": q_rating_from_sentiment,
    "launched_products": q_launched_products,
    # aggregates, set ops, joins
    "orders_monthly": _per_source(monthly.orders_monthly, "orders"),
    "reviews_monthly": _per_source(monthly.reviews_monthly, "reviews"),
    "inventory_monthly": _per_source(monthly.inventory_monthly, "inventory"),
    "activity_months": q_activity_months,
    "activity_with_catalog": q_activity_with_catalog,
    "monthly_joined": q_monthly_joined,
    "monthly_fused": q_monthly_fused,
    "monthly_metrics": lambda spark, sf_dir: m0(spark, sf_dir),
    "latest_month": lambda spark, sf_dir: with_latest(spark, sf_dir)[1],
    "current_month_rows": _current(monthly.current_rows),
    # marts
    "mart_overview": _current(marts.dashboard_overview),
    "mart_monthly_trends": lambda spark, sf_dir: marts.monthly_trends(m0(spark, sf_dir)),
    "mart_stage_sentiment": lambda spark, sf_dir: marts.stage_sentiment(m0(spark, sf_dir)),
    "mart_category_health": _current(marts.category_health),
    "mart_lifecycle_distribution": _current(marts.lifecycle_distribution),
    "mart_product_risk_scores": _risk,
    "mart_product_stage_history": _history,
    # marts of every month, merged from the states of buckets of products
    "category_health_by_month": _by_month(lambda groups: mart_states.category_health(groups, current=False)),
    "lifecycle_by_month": _by_month(lambda groups: mart_states.lifecycle_distribution(groups, current=False)),
    "risk_scores_by_month": q_risk_scores_by_month,
    # dashboard datasets
    "stage_transitions": lambda spark, sf_dir: insights.stage_transitions(_history(spark, sf_dir)),
    "alerts": lambda spark, sf_dir: insights.alerts(_risk(spark, sf_dir)),
    "filter_options": q_filter_options,
    "project_summary": lambda spark, sf_dir: insights.project_summary(_history(spark, sf_dir)),
    "summary_top_risk": q_summary_top_risk,
    "payload_rows_json": q_payload,
    # data quality
    "raw_rejects": q_raw_rejects,
    "catalog_duplicates": lambda spark, sf_dir: quality.catalog_duplicates(inputs(spark, sf_dir)["products"]),
    "orphan_products": lambda spark, sf_dir: quality.orphan_products(
        m0(spark, sf_dir), inputs(spark, sf_dir)["products"]
    ),
    # streaming
    "incremental_refresh": q_incremental_refresh,
    "refreshed_category_health": q_refreshed_category_health,
}
