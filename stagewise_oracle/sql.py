"""Oracle SQL (DuckDB dialect) for every registered query.

The driver's tables (``part``, ``lineitem``, ``orders`` ...) are views. The
adapter CTEs derive the four lifecycle datasets with the same expressions as
``stagewise.sources.adapters``; the rest restates each operator in SQL.
Rounding of averages/ratios/scores: ``round(x + sign(x)*1e-9, n) + 0.0e0``.
"""

from __future__ import annotations


def rhu(expr: str, n: int) -> str:
    return f"(round(({expr}) + sign({expr}) * 1e-9, {n}) + 0.0e0)"


def pid(key: str) -> str:
    return f"('P' || lpad(CAST({key} AS VARCHAR), 12, '0'))"

ADAPTERS = f"""
dim_products AS (
  SELECT {pid('p_partkey')} AS product_id,
         p_name AS product_name,
         lower(p_type) AS category,
         p_brand AS brand,
         CAST(CAST('1994-06-01' AS DATE) + CAST((p_partkey * 37) % 2600 AS INTEGER) AS DATE) AS launch_date,
         CAST(800 + p_size * 28 AS INTEGER) AS expected_lifecycle_days
  FROM part
),
f_sales AS (
  SELECT {pid('l_partkey')} AS product_id,
         l_shipdate AS order_ts,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) AS DECIMAL(12,0))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_pct,
         (l_returnflag = 'R' AND l_orderkey % 4 = 0) AS returned_flag
  FROM lineitem
),
f_reviews AS (
  SELECT {pid('l.l_partkey')} AS product_id,
         o.o_orderdate AS review_ts,
         CAST(1 + ((l.l_orderkey * 31 + l.l_linenumber * 17) % 1401) // 281 AS INTEGER) AS rating,
         CAST(CAST((l.l_orderkey * 31 + l.l_linenumber * 17) % 1401 - 600 AS DECIMAL(5,0))
              * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(7,3)) AS sentiment_score
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
f_inventory AS (
  SELECT {pid('l_partkey')} AS product_id,
         CAST(l_shipdate AS DATE) AS snapshot_date,
         CAST((l_suppkey * 97 + l_orderkey) % 500 AS INTEGER) AS stock_on_hand,
         CAST(CAST((l_orderkey * 13 + l_linenumber) % 3600 AS DECIMAL(5,0))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(7,2)) AS stockout_hours,
         CAST(CAST((l_orderkey * 29 + l_suppkey) % 890 + 80 AS DECIMAL(5,0))
              * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(7,3)) AS sell_through_pct
  FROM lineitem
)"""

MONTHLY = f"""
om AS (
  SELECT product_id, CAST(date_trunc('month', order_ts) AS DATE) AS month,
         CAST(sum(quantity) AS BIGINT) AS units_sold,
         CAST(round(sum(quantity * unit_price * (1 - discount_pct)), 2) AS DOUBLE) AS revenue,
         count(*) AS order_count,
         count(*) FILTER (WHERE returned_flag) AS returned_orders
  FROM f_sales GROUP BY 1, 2
),
rm AS (
  SELECT product_id, CAST(date_trunc('month', review_ts) AS DATE) AS month,
         {rhu('avg(CAST(rating AS DOUBLE))', 3)} AS avg_rating,
         {rhu('avg(CAST(sentiment_score AS DOUBLE))', 4)} AS avg_sentiment,
         count(*) AS review_count
  FROM f_reviews GROUP BY 1, 2
),
im AS (
  SELECT product_id, CAST(date_trunc('month', snapshot_date) AS DATE) AS month,
         {rhu('avg(CAST(stock_on_hand AS DOUBLE))', 2)} AS avg_stock_on_hand,
         {rhu('avg(CAST(stockout_hours AS DOUBLE))', 2)} AS avg_stockout_hours,
         {rhu('avg(CAST(sell_through_pct AS DOUBLE))', 4)} AS sell_through_pct
  FROM f_inventory GROUP BY 1, 2
),
act AS (
  SELECT product_id, month FROM om
  UNION SELECT product_id, month FROM rm
  UNION SELECT product_id, month FROM im
),
joined AS (
  SELECT a.product_id, a.month,
         p.product_name, p.category, p.brand, p.launch_date, p.expected_lifecycle_days,
         coalesce(om.units_sold, 0) AS units_sold,
         coalesce(om.revenue, 0.0e0) AS revenue,
         coalesce(om.order_count, 0) AS order_count,
         coalesce(om.returned_orders, 0) AS returned_orders,
         coalesce(rm.avg_rating, 0.0e0) AS avg_rating,
         coalesce(rm.avg_sentiment, 0.0e0) AS avg_sentiment,
         coalesce(rm.review_count, 0) AS review_count,
         coalesce(im.avg_stock_on_hand, 0.0e0) AS avg_stock_on_hand,
         coalesce(im.avg_stockout_hours, 0.0e0) AS avg_stockout_hours,
         coalesce(im.sell_through_pct, 0.0e0) AS sell_through_pct
  FROM act a
  LEFT JOIN dim_products p ON a.product_id = p.product_id
  LEFT JOIN om ON a.product_id = om.product_id AND a.month = om.month
  LEFT JOIN rm ON a.product_id = rm.product_id AND a.month = rm.month
  LEFT JOIN im ON a.product_id = im.product_id AND a.month = im.month
),
lagged AS (
  SELECT *,
         lag(revenue) OVER w AS revenue_prev,
         lag(avg_sentiment) OVER w AS sentiment_prev
  FROM joined
  WINDOW w AS (PARTITION BY product_id ORDER BY month)
),
derived AS (
  SELECT *,
         CASE WHEN revenue_prev > 0 THEN revenue / revenue_prev - 1.0e0 ELSE 0.0e0 END AS revenue_change,
         avg_sentiment - coalesce(sentiment_prev, avg_sentiment) AS sentiment_delta,
         CASE WHEN order_count > 0 THEN CAST(returned_orders AS DOUBLE) / CAST(order_count AS DOUBLE)
              ELSE 0.0e0 END AS return_rate,
         {rhu('avg_stockout_hours / 168.0e0', 4)} AS stockout_ratio,
         CAST(date_diff('day', launch_date, last_day(month)) AS INTEGER) AS age_days
  FROM lagged
),
derived2 AS (
  SELECT *, CAST(age_days AS DOUBLE) / CAST(expected_lifecycle_days AS DOUBLE) AS age_ratio FROM derived
),
scored AS (
  SELECT *,
         CASE WHEN coalesce(age_ratio, 0.0e0) < 0.18e0 THEN 'introduction'
              WHEN revenue_change >= 0.12e0 AND avg_sentiment >= 0.15e0 THEN 'growth'
              WHEN revenue_change >= -0.18e0 AND sell_through_pct >= 0.42e0 THEN 'maturity'
              ELSE 'decline' END AS lifecycle_stage,
         {rhu('''greatest(0.0e0, least(100.0e0,
              18.0e0 + greatest(0.0e0, -sentiment_delta) * 110.0e0 + greatest(0.0e0, -revenue_change) * 70.0e0
              + return_rate * 95.0e0 + stockout_ratio * 55.0e0 - greatest(0.0e0, revenue_change) * 15.0e0))''', 2)}
           AS risk_score,
         {rhu('''greatest(0.0e0, least(100.0e0,
              22.0e0 + greatest(0.0e0, avg_sentiment) * 36.0e0 + greatest(0.0e0, 0.12e0 - revenue_change) * 40.0e0
              + CAST(least(review_count, 400) AS DOUBLE) / 20.0e0))''', 2)} AS opportunity_score
  FROM derived2
),
m0 AS (
  SELECT product_id, month, product_name, category, brand, launch_date, expected_lifecycle_days,
         units_sold, revenue, order_count, returned_orders, avg_rating, avg_sentiment, review_count,
         avg_stock_on_hand, avg_stockout_hours, sell_through_pct,
         revenue_change, sentiment_delta, return_rate, stockout_ratio, age_days, age_ratio,
         lifecycle_stage, risk_score,
         CASE WHEN risk_score >= 75.0e0 THEN 'critical' WHEN risk_score >= 55.0e0 THEN 'watch'
              ELSE 'stable' END AS risk_bucket,
         opportunity_score
  FROM scored
),
cur AS (
  SELECT * FROM m0 WHERE month = (SELECT max(month) FROM m0)
)"""

HISTORY_COLS = f"""
  product_id, product_name, category, brand, month, lifecycle_stage, risk_bucket,
  {rhu('revenue', 2)} AS revenue, {rhu('revenue_change', 4)} AS revenue_change,
  units_sold, review_count, {rhu('avg_sentiment', 4)} AS avg_sentiment,
  {rhu('sentiment_delta', 4)} AS sentiment_delta, {rhu('avg_rating', 3)} AS avg_rating,
  {rhu('risk_score', 2)} AS risk_score, {rhu('opportunity_score', 2)} AS opportunity_score,
  {rhu('return_rate', 4)} AS return_rate, {rhu('stockout_ratio', 4)} AS stockout_ratio,
  CAST(age_days AS DOUBLE) AS age_days"""

RISK_COLS = f"""
  product_id, product_name, category, brand, month, lifecycle_stage, risk_bucket,
  {rhu('risk_score', 2)} AS risk_score, {rhu('opportunity_score', 2)} AS opportunity_score,
  {rhu('revenue', 2)} AS revenue, {rhu('revenue_change', 4)} AS revenue_change,
  {rhu('sentiment_delta', 4)} AS sentiment_delta, {rhu('return_rate', 4)} AS return_rate,
  {rhu('stockout_ratio', 4)} AS stockout_ratio"""

RISK_ORDER = "risk_score DESC NULLS LAST, revenue DESC NULLS LAST, product_id ASC NULLS FIRST"

MARTS = f"""
history AS (SELECT {HISTORY_COLS} FROM m0),
risk AS (SELECT {RISK_COLS} FROM cur ORDER BY {RISK_ORDER} LIMIT 25),
overview AS (
  SELECT max(month) AS latest_month,
         CAST(count(DISTINCT product_id) AS INTEGER) AS active_products,
         CAST(sum(units_sold) AS BIGINT) AS units_sold,
         CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue,
         {rhu('avg(avg_rating)', 3)} AS avg_rating,
         {rhu('avg(avg_sentiment)', 4)} AS avg_sentiment,
         CAST(count(*) FILTER (WHERE risk_score >= 75.0e0) AS INTEGER) AS at_risk_products
  FROM cur
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


BASE = _with(ADAPTERS, MONTHLY, MARTS)


def q(select: str) -> str:
    return BASE + "\n" + select


def _fixed(expr: str, n: int) -> str:
    return f"printf('%.{n}f', CAST({expr} AS DOUBLE))"


def _percent(expr: str, n: int = 1) -> str:
    return f"({_fixed(f'CAST({expr} AS DOUBLE) * 100.0e0', n)} || '%')"


def _iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


ALERTS = f"""
SELECT title, metric, severity, detail FROM (
  SELECT
    CASE WHEN rs >= 70.0e0 THEN 'Risk score threshold breached'
         WHEN rr >= 0.25e0 THEN 'Return rate alert'
         WHEN sd <= -0.15e0 THEN 'Sentiment decline' END AS title,
    CASE WHEN product_name IS NOT NULL AND product_name <> '' THEN product_name ELSE product_id END AS metric,
    CASE WHEN rs >= 70.0e0 THEN (CASE WHEN rs >= 80.0e0 THEN 'high' ELSE 'medium' END)
         WHEN rr >= 0.25e0 THEN 'medium'
         WHEN sd <= -0.15e0 THEN 'low' END AS severity,
    CASE WHEN rs >= 70.0e0 THEN cat || ' · ' || coalesce(lifecycle_stage, 'stage') || ' · Risk ' || {_fixed('rs', 1)}
                               || ' in ' || mon
         WHEN rr >= 0.25e0 THEN 'Return rate ' || {_percent('rr', 1)} || ' · ' || cat || ' · ' || mon
         WHEN sd <= -0.15e0 THEN 'Sentiment Δ ' || {_fixed('sd', 3)} || ' · ' || cat || ' · ' || mon
    END AS detail,
    risk_score, revenue, product_id
  FROM (SELECT *, coalesce(risk_score, 0.0e0) AS rs, coalesce(return_rate, 0.0e0) AS rr,
               coalesce(sentiment_delta, 0.0e0) AS sd, coalesce(category, 'Unknown category') AS cat,
               coalesce({_iso('month')}, 'None') AS mon
        FROM risk) x
) y WHERE title IS NOT NULL
ORDER BY {RISK_ORDER} LIMIT 10"""

TRANSITIONS = """
SELECT from_stage, to_stage, product_count FROM (
  SELECT from_stage, to_stage, count(*) AS product_count,
         min(struct_pack(fm := first_month, pid := product_id, m := month)) AS first_seen
  FROM (
    SELECT product_id, month,
           lag(lifecycle_stage) OVER w AS from_stage, lifecycle_stage AS to_stage,
           row_number() OVER w AS n,
           min(month) OVER (PARTITION BY product_id) AS first_month
    FROM history
    WINDOW w AS (PARTITION BY product_id ORDER BY month)
  ) p WHERE n > 1
  GROUP BY from_stage, to_stage
) c ORDER BY product_count DESC, first_seen LIMIT 8"""

FILTER_OPTIONS = f"""
SELECT DISTINCT 'months' AS option, {_iso('month')} AS value FROM history WHERE month IS NOT NULL
UNION ALL SELECT DISTINCT 'categories', category FROM history WHERE category IS NOT NULL AND category <> ''
UNION ALL SELECT DISTINCT 'brands', brand FROM history WHERE brand IS NOT NULL AND brand <> ''
UNION ALL SELECT 'lifecycle_stages', unnest(['introduction', 'growth', 'maturity', 'decline'])
UNION ALL SELECT DISTINCT 'risk_buckets', risk_bucket FROM risk WHERE risk_bucket IS NOT NULL AND risk_bucket <> ''
UNION ALL SELECT 'default_month', {_iso('max(month)')} FROM history"""

SUMMARY = f"""
SELECT 1 AS line_no, 'Latest month: ' || coalesce({_iso('latest_month')}, 'N/A') AS line FROM overview
UNION ALL SELECT 2, 'Active products: ' || CAST(coalesce(active_products, 0) AS VARCHAR) FROM overview
UNION ALL SELECT 3, 'Revenue: ' || format('{{:,.0f}}', coalesce(revenue, 0.0e0)) FROM overview
UNION ALL SELECT 4, 'Avg sentiment: ' || {_fixed('coalesce(avg_sentiment, 0.0e0)', 3)} FROM overview
UNION ALL SELECT 5, 'Top Risk Products'
UNION ALL SELECT CAST(5 + row_number() OVER (ORDER BY {RISK_ORDER}) AS INTEGER),
  coalesce(product_name, 'Unknown') || ' | Risk ' || {_fixed('coalesce(risk_score, 0.0e0)', 1)}
  || ' | Returns ' || {_percent('coalesce(return_rate, 0.0e0)', 1)}
  || ' | Sentiment Δ ' || {_fixed('coalesce(sentiment_delta, 0.0e0)', 3)}
FROM (SELECT * FROM risk ORDER BY {RISK_ORDER} LIMIT 12) t"""

M0_COLS = (
    "product_id, month, product_name, category, brand, launch_date, expected_lifecycle_days, "
    "units_sold, revenue, order_count, returned_orders, avg_rating, avg_sentiment, review_count, "
    "avg_stock_on_hand, avg_stockout_hours, sell_through_pct"
)


RAW_REJECTS = """
SELECT 'orders' AS dataset, field, value, reason, count(*) AS n FROM (
  SELECT 'order_ts' AS field, l_returnflag || '-' || l_linestatus AS value, 'not a timestamp' AS reason FROM lineitem WHERE l_linenumber = 1
  UNION ALL SELECT 'quantity', l_returnflag, 'not an integer' FROM lineitem WHERE l_linenumber = 2
  UNION ALL SELECT 'discount_pct', l_linestatus, 'not a number of the field''s precision' FROM lineitem WHERE l_linenumber = 3
  UNION ALL SELECT 'returned_flag', 'maybe ' || l_returnflag, 'not a boolean' FROM lineitem WHERE l_linenumber = 4
) GROUP BY ALL
"""


def oracle_queries() -> dict[str, str]:
    return {
        # ---- sources (S2..S5 via JSON round trip; S1/K7 roundtrip) ----
        "src_products": q(
            "SELECT product_id, product_name, category, brand, launch_date, CAST(NULL AS DOUBLE) AS base_price, "
            "CAST(NULL AS INTEGER) AS base_monthly_orders, expected_lifecycle_days, "
            "CAST(NULL AS DOUBLE) AS base_sentiment FROM dim_products"
        ),
        "src_orders": q(
            "SELECT product_id, order_ts, quantity, CAST(unit_price AS DECIMAL(18,4)) AS unit_price, "
            "CAST(discount_pct AS DECIMAL(9,4)) AS discount_pct, returned_flag FROM f_sales"
        ),
        "src_reviews": q(
            "SELECT product_id, review_ts, rating, CAST(sentiment_score AS DOUBLE) AS sentiment_score FROM f_reviews"
        ),
        "src_inventory": q(
            "SELECT product_id, snapshot_date, stock_on_hand, CAST(stockout_hours AS DOUBLE) AS stockout_hours, "
            "CAST(sell_through_pct AS DOUBLE) AS sell_through_pct FROM f_inventory"
        ),
        "src_json_roundtrip": q("SELECT * FROM om"),
        # ---- scalar operators ----
        "month_key": q(
            "SELECT CAST(date_trunc('month', order_ts) AS DATE) AS month, "
            "last_day(CAST(date_trunc('month', order_ts) AS DATE)) AS month_end, "
            "CAST(CAST(date_trunc('month', order_ts) AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month, "
            "CAST(CAST(date_trunc('month', order_ts) AS DATE) - INTERVAL 1 MONTH AS DATE) AS prev_month, "
            "count(*) AS order_count FROM f_sales GROUP BY 1, 2, 3, 4"
        ),
        "net_revenue": q(
            "SELECT product_id, CAST(round(sum(quantity * unit_price * (1 - discount_pct)), 2) AS DOUBLE) "
            "AS net_revenue FROM f_sales GROUP BY product_id"
        ),
        "return_rate": q("SELECT product_id, month, order_count, returned_orders, return_rate FROM m0"),
        "revenue_change": q("SELECT product_id, month, revenue, revenue_change FROM m0"),
        "sentiment_delta": q("SELECT product_id, month, avg_sentiment, sentiment_delta FROM m0"),
        "stockout_ratio": q("SELECT product_id, month, avg_stockout_hours, stockout_ratio FROM m0"),
        "product_age": q("SELECT product_id, month, launch_date, age_days, age_ratio FROM m0"),
        "lifecycle_stage": q("SELECT product_id, month, lifecycle_stage FROM m0"),
        "risk_score": q("SELECT product_id, month, risk_score FROM m0"),
        "risk_bucket": q("SELECT product_id, month, risk_score, risk_bucket FROM m0"),
        "opportunity_score": q("SELECT product_id, month, opportunity_score FROM m0"),
        "age_stage": q(
            "SELECT product_id, month, CASE WHEN age_ratio < 0.20e0 THEN 'introduction' "
            "WHEN age_ratio < 0.46e0 THEN 'growth' WHEN age_ratio < 0.82e0 THEN 'maturity' "
            "ELSE 'decline' END AS age_stage FROM m0 WHERE age_ratio IS NOT NULL"
        ),
        "rating_from_sentiment": q(
            "SELECT product_id, review_ts, sentiment_score, "
            "round_even(greatest(-1.0e0, least(1.0e0, CAST(sentiment_score AS DOUBLE))), 3) AS clamped_sentiment, "
            "greatest(1, least(5, CAST(round_even((CAST(sentiment_score AS DOUBLE) + 1.0e0) / 2.0e0 * 4.0e0 "
            "+ 1.0e0, 0) AS INTEGER))) AS implied_rating FROM f_reviews"
        ),
        "launched_products": q(
            "SELECT month, CAST(count(*) AS BIGINT) AS launched_products, "
            "CAST(sum(date_diff('day', launch_date, last_day(month))) AS BIGINT) AS total_age_days "
            "FROM m0 WHERE launch_date <= last_day(month) GROUP BY month"
        ),
        # ---- aggregates, set ops, joins ----
        "orders_monthly": q("SELECT * FROM om"),
        "src_orders_latest_month": q("SELECT * FROM om WHERE month = (SELECT max(month) FROM om)"),
        "reviews_monthly": q("SELECT * FROM rm"),
        "inventory_monthly": q("SELECT * FROM im"),
        "activity_months": q("SELECT * FROM act"),
        "activity_with_catalog": q(
            "SELECT a.product_id, a.month, p.product_name, p.category, p.brand, p.launch_date, "
            "p.expected_lifecycle_days FROM act a LEFT JOIN dim_products p ON a.product_id = p.product_id"
        ),
        "monthly_joined": q(f"SELECT {M0_COLS} FROM joined"),
        "monthly_fused": q(f"SELECT {M0_COLS} FROM joined"),
        "monthly_metrics": q("SELECT * FROM m0"),
        "latest_month": q("SELECT max(month) AS latest_month FROM m0"),
        "current_month_rows": q("SELECT * FROM cur"),
        # ---- marts ----
        "mart_overview": q("SELECT * FROM overview"),
        "mart_monthly_trends": q(
            "SELECT month, CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue, "
            f"CAST(sum(units_sold) AS BIGINT) AS units_sold, {rhu('avg(avg_rating)', 3)} AS avg_rating, "
            f"{rhu('avg(avg_sentiment)', 4)} AS avg_sentiment FROM m0 GROUP BY month"
        ),
        "mart_stage_sentiment": q(
            f"SELECT month, lifecycle_stage, {rhu('avg(avg_sentiment)', 4)} AS avg_sentiment, "
            f"{rhu('avg(avg_rating)', 3)} AS avg_rating, CAST(sum(review_count) AS BIGINT) AS review_count, "
            "CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue "
            "FROM m0 GROUP BY month, lifecycle_stage"
        ),
        "mart_category_health": q(
            "SELECT category, CAST(count(DISTINCT product_id) AS INTEGER) AS active_products, "
            "CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue, "
            f"{rhu('avg(avg_sentiment)', 4)} AS avg_sentiment, {rhu('avg(revenue_change)', 4)} AS revenue_change, "
            f"{rhu('avg(return_rate)', 4)} AS return_rate, "
            "CAST(count(*) FILTER (WHERE risk_score >= 75.0e0) AS INTEGER) AS at_risk_products "
            "FROM cur GROUP BY category"
        ),
        "mart_lifecycle_distribution": q(
            "SELECT lifecycle_stage, CAST(count(DISTINCT product_id) AS INTEGER) AS product_count, "
            f"{rhu('avg(CAST(age_days AS DOUBLE))', 2)} AS avg_age_days, "
            f"{rhu('CAST(avg(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE)', 2)} AS avg_revenue, "
            f"{rhu('avg(avg_sentiment)', 4)} AS avg_sentiment FROM cur GROUP BY lifecycle_stage"
        ),
        "mart_product_risk_scores": q("SELECT * FROM risk"),
        "mart_product_stage_history": q("SELECT * FROM history"),
        # ---- marts of every month ----
        "category_health_by_month": q(
            "SELECT month, category, CAST(count(DISTINCT product_id) AS INTEGER) AS active_products, "
            "CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue, "
            f"{rhu('avg(avg_sentiment)', 4)} AS avg_sentiment, {rhu('avg(revenue_change)', 4)} AS revenue_change, "
            f"{rhu('avg(return_rate)', 4)} AS return_rate, "
            "CAST(count(*) FILTER (WHERE risk_score >= 75.0e0) AS INTEGER) AS at_risk_products "
            "FROM m0 GROUP BY month, category"
        ),
        "lifecycle_by_month": q(
            "SELECT month, lifecycle_stage, CAST(count(DISTINCT product_id) AS INTEGER) AS product_count, "
            f"{rhu('avg(CAST(age_days AS DOUBLE))', 2)} AS avg_age_days, "
            f"{rhu('CAST(avg(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE)', 2)} AS avg_revenue, "
            f"{rhu('avg(avg_sentiment)', 4)} AS avg_sentiment FROM m0 GROUP BY month, lifecycle_stage"
        ),
        "risk_scores_by_month": q(
            f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY month ORDER BY {RISK_ORDER}) AS INTEGER) AS place "
            f"FROM (SELECT {RISK_COLS} FROM m0)) WHERE place <= 25"
        ),
        # ---- dashboard datasets ----
        "stage_transitions": q(TRANSITIONS),
        "alerts": q(ALERTS),
        "raw_rejects": RAW_REJECTS,
        "filter_options": q(FILTER_OPTIONS),
        "project_summary": q(
            "SELECT count(DISTINCT CASE WHEN product_id IS NOT NULL AND product_id <> '' THEN product_id END) "
            "AS product_count, count(DISTINCT month) AS month_count FROM history"
        ),
        "summary_top_risk": q(SUMMARY),
        # ---- data quality ----
        "catalog_duplicates": q(
            "SELECT product_id, count(*) AS copies FROM dim_products GROUP BY product_id HAVING count(*) > 1"
        ),
        "orphan_products": q(
            "SELECT product_id, min(month) AS first_month, max(month) AS last_month, count(*) AS active_months, "
            "CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM m0 "
            "WHERE NOT EXISTS (SELECT 1 FROM dim_products p WHERE p.product_id = m0.product_id) "
            "GROUP BY product_id"
        ),
        # ---- streaming refresh (result equals the batch fact table) ----
        "incremental_refresh": q("SELECT * FROM m0"),
        "refreshed_category_health": q(
            "SELECT category, CAST(count(DISTINCT product_id) AS INTEGER) AS active_products, "
            "CAST(round(sum(CAST(revenue AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue, "
            f"{rhu('avg(avg_sentiment)', 4)} AS avg_sentiment, {rhu('avg(revenue_change)', 4)} AS revenue_change, "
            f"{rhu('avg(return_rate)', 4)} AS return_rate, "
            "CAST(count(*) FILTER (WHERE risk_score >= 75.0e0) AS INTEGER) AS at_risk_products "
            "FROM cur GROUP BY category"
        ),
    }
