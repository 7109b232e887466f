"""Schemas: raw JSON fields, typed datasets, monthly metrics and the marts."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, DB = T.StringType(), T.DateType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def _raw(*names: str) -> T.StructType:
    # Raw JSON is read as text for the fields we use; the parser keeps the
    # literal text of numbers/booleans, and typed projection uses try_* casts.
    return _struct(*[(n, S) for n in names])


# Only the fields downstream operators need: the JSON parser skips the rest.
RAW_PRODUCTS = _raw(
    "product_id", "product_name", "category", "brand", "launch_date",
    "base_price", "base_monthly_orders", "expected_lifecycle_days", "base_sentiment",
)
RAW_ORDERS = _raw("product_id", "order_ts", "quantity", "unit_price", "discount_pct", "returned_flag")
RAW_REVIEWS = _raw("product_id", "review_ts", "rating", "sentiment_score")
RAW_INVENTORY = _raw("product_id", "snapshot_date", "stock_on_hand", "stockout_hours", "sell_through_pct")

# Eight decimals; quantity * price * (1 - rate) of these types is DECIMAL(38,9).
PRICE_TYPE = T.DecimalType(20, 8)
RATE_TYPE = T.DecimalType(12, 8)

PRODUCTS = _struct(
    ("product_id", S), ("product_name", S), ("category", S), ("brand", S), ("launch_date", D),
    ("base_price", DB), ("base_monthly_orders", I), ("expected_lifecycle_days", I), ("base_sentiment", DB),
)
ORDERS = _struct(
    ("product_id", S), ("order_ts", T.TimestampNTZType()), ("quantity", I),
    ("unit_price", PRICE_TYPE), ("discount_pct", RATE_TYPE), ("returned_flag", T.BooleanType()),
)
# Event times are UTC wall-clock (TIMESTAMP_NTZ): independent of the session time zone.
REVIEWS = _struct(("product_id", S), ("review_ts", T.TimestampNTZType()), ("rating", I), ("sentiment_score", DB))
INVENTORY = _struct(
    ("product_id", S), ("snapshot_date", D), ("stock_on_hand", I),
    ("stockout_hours", DB), ("sell_through_pct", DB),
)

# Catalogue attributes carried into the monthly fact table.
CATALOG_COLUMNS = ("product_id", "product_name", "category", "brand", "launch_date", "expected_lifecycle_days")

MONTHLY_METRICS = _struct(
    ("product_id", S), ("month", D),
    ("product_name", S), ("category", S), ("brand", S), ("launch_date", D), ("expected_lifecycle_days", I),
    ("units_sold", L), ("revenue", DB), ("order_count", L), ("returned_orders", L),
    ("avg_rating", DB), ("avg_sentiment", DB), ("review_count", L),
    ("avg_stock_on_hand", DB), ("avg_stockout_hours", DB), ("sell_through_pct", DB),
    ("revenue_change", DB), ("sentiment_delta", DB), ("return_rate", DB), ("stockout_ratio", DB),
    ("age_days", I), ("age_ratio", DB),
    ("lifecycle_stage", S), ("risk_score", DB), ("risk_bucket", S), ("opportunity_score", DB),
)

# --- mart schemas (column order is the write order) -----------------------
MARTS: dict[str, T.StructType] = {
    "dashboard_overview": _struct(
        ("latest_month", D), ("active_products", I), ("units_sold", L), ("revenue", DB),
        ("avg_rating", DB), ("avg_sentiment", DB), ("at_risk_products", I),
    ),
    "monthly_trends": _struct(
        ("month", D), ("revenue", DB), ("units_sold", L), ("avg_rating", DB), ("avg_sentiment", DB),
    ),
    "stage_sentiment": _struct(
        ("month", D), ("lifecycle_stage", S), ("avg_sentiment", DB), ("avg_rating", DB),
        ("review_count", L), ("revenue", DB),
    ),
    "category_health": _struct(
        ("category", S), ("active_products", I), ("revenue", DB), ("avg_sentiment", DB),
        ("revenue_change", DB), ("return_rate", DB), ("at_risk_products", I),
    ),
    "lifecycle_distribution": _struct(
        ("lifecycle_stage", S), ("product_count", I), ("avg_age_days", DB), ("avg_revenue", DB),
        ("avg_sentiment", DB),
    ),
    "product_risk_scores": _struct(
        ("product_id", S), ("product_name", S), ("category", S), ("brand", S), ("month", D),
        ("lifecycle_stage", S), ("risk_bucket", S), ("risk_score", DB), ("opportunity_score", DB),
        ("revenue", DB), ("revenue_change", DB), ("sentiment_delta", DB), ("return_rate", DB),
        ("stockout_ratio", DB),
    ),
    "product_stage_history": _struct(
        ("product_id", S), ("product_name", S), ("category", S), ("brand", S), ("month", D),
        ("lifecycle_stage", S), ("risk_bucket", S), ("revenue", DB), ("revenue_change", DB),
        ("units_sold", L), ("review_count", L), ("avg_sentiment", DB), ("sentiment_delta", DB),
        ("avg_rating", DB), ("risk_score", DB), ("opportunity_score", DB), ("return_rate", DB),
        ("stockout_ratio", DB), ("age_days", DB),
    ),
}

# Default reading order of each mart (order stored in files is not a contract).
MART_ORDER: dict[str, list[tuple[str, bool]]] = {
    "dashboard_overview": [],
    "monthly_trends": [("month", True)],
    "stage_sentiment": [("month", True), ("lifecycle_stage", True)],
    "category_health": [("revenue", False), ("category", True)],
    "lifecycle_distribution": [("product_count", False), ("lifecycle_stage", True)],
    "product_risk_scores": [("risk_score", False), ("revenue", False), ("product_id", True)],
    "product_stage_history": [("month", True), ("product_id", True)],
}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to exactly ``schema`` (names, order, types)."""
    from pyspark.sql import functions as F

    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def assert_schema(df, schema: T.StructType) -> None:
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if got != want:
        raise ValueError(f"schema mismatch: got {got}, want {want}")
