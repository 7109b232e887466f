"""Product-by-month fact table (``monthly_metrics``).

Two equivalent plans build the zero-filled monthly table:

* :func:`monthly_joined` — one aggregate per source, the union of their
  (product, month) keys, then three left joins and a null fill;
* :func:`monthly_fused` — the three sources unioned with null-padded measure
  columns and aggregated in **one** group-by (one shuffle instead of three
  aggregates, a distinct and three joins). Group presence decides the zero
  fill, exactly as the join version does.

Both aggregate before any shuffle of raw rows: partial aggregation runs on
the map side, so a product holding a third of all rows still ships at most
one partial row per (product, month) per task.

:func:`score_monthly` then adds month-over-month deltas (``lag`` over the
product's previous *existing* month), age, stage and scores. A product has at
most one row per month, so the window groups are bounded by the number of
months regardless of data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import (
    age_days,
    age_ratio,
    fill_double,
    fill_value,
    lifecycle_stage,
    month_key,
    opportunity_score,
    risk_bucket,
    risk_score,
    round_half_up,
)
from ..schemas import CATALOG_COLUMNS, MONTHLY_METRICS

KEYS = ["product_id", "month"]


def net_revenue(quantity="quantity", unit_price="unit_price", discount_pct="discount_pct") -> F.Column:
    """``quantity * unit_price * (1 - discount_pct)``; exact on DECIMAL input."""
    q, p, d = F.col(quantity), F.col(unit_price), F.col(discount_pct)
    return q * p * (F.lit(1) - d)


def _revenue(total: F.Column) -> F.Column:
    return F.round(total, 2).cast("double")


# --- A1..A3: one aggregate per source --------------------------------------

def orders_monthly(orders: DataFrame) -> DataFrame:
    return (
        orders.select(
            "product_id",
            month_key("order_ts").alias("month"),
            "quantity",
            net_revenue().alias("net_revenue"),
            "returned_flag",
        )
        .groupBy(*KEYS)
        .agg(
            F.sum("quantity").cast("bigint").alias("units_sold"),
            _revenue(F.sum("net_revenue")).alias("revenue"),
            F.count(F.lit(1)).alias("order_count"),
            F.count_if(F.col("returned_flag")).alias("returned_orders"),
        )
    )


def reviews_monthly(reviews: DataFrame) -> DataFrame:
    return (
        reviews.select("product_id", month_key("review_ts").alias("month"), "rating", "sentiment_score")
        .groupBy(*KEYS)
        .agg(
            round_half_up(F.avg(F.col("rating").cast("double")), 3).alias("avg_rating"),
            round_half_up(F.avg(F.col("sentiment_score").cast("double")), 4).alias("avg_sentiment"),
            F.count(F.lit(1)).alias("review_count"),
        )
    )


def inventory_monthly(inventory: DataFrame) -> DataFrame:
    return (
        inventory.select(
            "product_id",
            month_key("snapshot_date").alias("month"),
            "stock_on_hand",
            "stockout_hours",
            "sell_through_pct",
        )
        .groupBy(*KEYS)
        .agg(
            round_half_up(F.avg(F.col("stock_on_hand").cast("double")), 2).alias("avg_stock_on_hand"),
            round_half_up(F.avg(F.col("stockout_hours").cast("double")), 2).alias("avg_stockout_hours"),
            round_half_up(F.avg(F.col("sell_through_pct").cast("double")), 4).alias("sell_through_pct"),
        )
    )


# --- U1: activity keys -----------------------------------------------------

def activity_months(orders_m: DataFrame, reviews_m: DataFrame, inventory_m: DataFrame) -> DataFrame:
    return (
        orders_m.select(*KEYS)
        .unionByName(reviews_m.select(*KEYS))
        .unionByName(inventory_m.select(*KEYS))
        .distinct()
    )


# --- P9: zero fill ----------------------------------------------------------

_FILL_LONG = ("units_sold", "order_count", "returned_orders", "review_count")
_FILL_DOUBLE = ("revenue", "avg_rating", "avg_sentiment", "avg_stock_on_hand", "avg_stockout_hours", "sell_through_pct")
MEASURES = (
    "units_sold", "revenue", "order_count", "returned_orders",
    "avg_rating", "avg_sentiment", "review_count",
    "avg_stock_on_hand", "avg_stockout_hours", "sell_through_pct",
)


def _join_visible(df: DataFrame) -> DataFrame:
    """Blank the measures of groups with a NULL key.

    In the join-based definition a NULL ``product_id`` or ``month`` never
    matches the equi-join back to the per-source aggregates, so such a group
    keeps its key but gets zero-filled measures. The fused plan keeps that.
    """
    keyed = F.col("product_id").isNotNull() & F.col("month").isNotNull()
    return df.select(
        *[F.when(keyed, F.col(c)).alias(c) if c in MEASURES else F.col(c) for c in df.columns]
    )


def _zero_filled(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Select ``columns`` (default: all) with the null/NaN fill applied."""
    out = []
    for name in columns or df.columns:
        if name in _FILL_LONG:
            out.append(fill_value(name, 0).cast("bigint").alias(name))
        elif name in _FILL_DOUBLE:
            out.append(fill_double(name, 0.0).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def catalog(products: DataFrame) -> DataFrame:
    """The catalogue attributes carried into the fact table."""
    return products.select(*CATALOG_COLUMNS)


# --- J1..J4 + P9: three-join plan -----------------------------------------

def monthly_joined(products: DataFrame, orders: DataFrame, reviews: DataFrame, inventory: DataFrame) -> DataFrame:
    om, rm, im = orders_monthly(orders), reviews_monthly(reviews), inventory_monthly(inventory)
    joined = (
        activity_months(om, rm, im)
        .join(catalog(products), "product_id", "left")
        .join(om, KEYS, "left")
        .join(rm, KEYS, "left")
        .join(im, KEYS, "left")
    )
    return _zero_filled(joined)


# --- A13: fused single-shuffle plan ---------------------------------------

def monthly_facts(orders: DataFrame, reviews: DataFrame, inventory: DataFrame) -> DataFrame:
    """Union of the three sources as one narrow fact stream.

    Marker columns ``_o`` and ``_r`` are 1 on order and review rows and NULL
    elsewhere; counting them gives the order and review counts of a group
    (inventory only contributes averages).
    """
    o = orders.select(
        "product_id",
        month_key("order_ts").alias("month"),
        F.col("quantity").cast("bigint").alias("quantity"),
        net_revenue().alias("net_revenue"),
        F.col("returned_flag").alias("returned_flag"),
        F.lit(1).alias("_o"),
    )
    r = reviews.select(
        "product_id",
        month_key("review_ts").alias("month"),
        F.col("rating").cast("double").alias("rating"),
        F.col("sentiment_score").cast("double").alias("sentiment_score"),
        F.lit(1).alias("_r"),
    )
    i = inventory.select(
        "product_id",
        month_key("snapshot_date").alias("month"),
        F.col("stock_on_hand").cast("double").alias("stock_on_hand"),
        F.col("stockout_hours").cast("double").alias("stockout_hours"),
        F.col("sell_through_pct").cast("double").alias("sell_through_pct"),
    )
    return o.unionByName(r, allowMissingColumns=True).unionByName(i, allowMissingColumns=True)


def monthly_aggregate(facts: DataFrame) -> DataFrame:
    """One group-by over the fact stream; same columns as the three aggregates."""
    return facts.groupBy(*KEYS).agg(
        F.sum("quantity").alias("units_sold"),
        _revenue(F.sum("net_revenue")).alias("revenue"),
        F.count("_o").alias("order_count"),
        F.count_if(F.col("returned_flag")).alias("returned_orders"),
        round_half_up(F.avg("rating"), 3).alias("avg_rating"),
        round_half_up(F.avg("sentiment_score"), 4).alias("avg_sentiment"),
        F.count("_r").alias("review_count"),
        round_half_up(F.avg("stock_on_hand"), 2).alias("avg_stock_on_hand"),
        round_half_up(F.avg("stockout_hours"), 2).alias("avg_stockout_hours"),
        round_half_up(F.avg("sell_through_pct"), 4).alias("sell_through_pct"),
    )


def monthly_fused(products: DataFrame, orders: DataFrame, reviews: DataFrame, inventory: DataFrame) -> DataFrame:
    agg = _join_visible(monthly_aggregate(monthly_facts(orders, reviews, inventory)))
    # Catalogue join after aggregation: the fact side is already reduced to
    # one row per (product, month). AQE broadcasts the catalogue when its
    # measured size is under the threshold, else keeps a shuffle join.
    joined = agg.join(catalog(products), "product_id", "left")
    order = ["product_id", "month", *[c for c in CATALOG_COLUMNS if c != "product_id"], *MEASURES]
    return _zero_filled(joined, order)


# --- W1..W2, P3..P16: deltas, age, stage, scores ----------------------------

def product_window(*within: str) -> Window:
    return Window.partitionBy(*within, "product_id").orderBy("month")


def score_monthly(monthly: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Add deltas, age and scores to a zero-filled monthly table (M0).

    Two projections only: the lag columns, then every derived column in one
    select (shared sub-expressions are evaluated once by codegen).
    ``within``: columns that a product has one value of; they are kept, last,
    and the rows of a task come sorted by them, then by product and month.
    """
    w = product_window(*within)
    with_prev = monthly.select(
        "*",
        F.lag("revenue").over(w).alias("_revenue_prev"),
        F.lag("avg_sentiment").over(w).alias("_sentiment_prev"),
    )
    prev = F.col("_revenue_prev")
    rc = fill_double(F.when(prev > F.lit(0.0), F.col("revenue") / prev - F.lit(1.0)).otherwise(F.lit(0.0)))
    sd = fill_double(F.col("avg_sentiment") - F.coalesce(F.col("_sentiment_prev"), F.col("avg_sentiment")))
    rr = fill_double(
        F.when(
            F.col("order_count") > F.lit(0),
            F.col("returned_orders").cast("double") / F.col("order_count").cast("double"),
        ).otherwise(F.lit(0.0))
    )
    so = fill_double(round_half_up(F.col("avg_stockout_hours") / F.lit(K.HOURS_PER_WEEK), 4))
    age = age_days("month", "launch_date")
    ratio = age_ratio(age, "expected_lifecycle_days")
    risk = risk_score(sd, rc, rr, so)
    derived = {
        "revenue_change": rc,
        "sentiment_delta": sd,
        "return_rate": rr,
        "stockout_ratio": so,
        "age_days": age,
        "age_ratio": ratio,
        "lifecycle_stage": lifecycle_stage(ratio, rc, "avg_sentiment", "sell_through_pct"),
        "risk_score": risk,
        "risk_bucket": risk_bucket(risk),
        "opportunity_score": opportunity_score("avg_sentiment", rc, "review_count"),
    }
    return with_prev.select(
        *[(derived[f.name] if f.name in derived else F.col(f.name)).cast(f.dataType).alias(f.name)
          for f in MONTHLY_METRICS.fields],
        *within,
    )


def monthly_metrics(
    products: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    inventory: DataFrame,
    fused: bool = True,
) -> DataFrame:
    """M0: the scored product-by-month table."""
    build = monthly_fused if fused else monthly_joined
    return score_monthly(build(products, orders, reviews, inventory))


def latest_month(monthly: DataFrame) -> DataFrame:
    """A4: one row, one column ``latest_month`` (NULL when empty)."""
    return monthly.agg(F.max("month").alias("latest_month"))


def latest_activity_month(orders: DataFrame, reviews: DataFrame, inventory: DataFrame) -> DataFrame:
    """A4 without the fact table: the month of the latest date in any source.

    Every month with activity is a month of the fact table, whatever the
    product (NULL too), so the two agree. Each source is scanned for its date
    column alone and gives one partial row per task.
    """
    dates = [(orders, "order_ts"), (reviews, "review_ts"), (inventory, "snapshot_date")]
    found = [df.select(month_key(c).alias("month")).agg(F.max("month").alias("month")) for df, c in dates]
    return latest_month(found[0].unionByName(found[1]).unionByName(found[2]))


def current_rows(monthly: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """P10: rows of the latest month over all products (scalar subquery).

    ``latest``: one row and column with that month, where it is known without
    ``monthly``; else ``monthly`` is computed twice unless it is stored.
    """
    month = (monthly.select(F.max("month")) if latest is None else latest).scalar()
    return monthly.filter(F.col("month") == month)
