"""Fixed values that decide results.

These numbers and labels must stay exactly as written: they are the business
rules of the lifecycle model (stage thresholds, score weights, alert rules).
"""

from __future__ import annotations

# --- fixed values: lifecycle stages, in lifecycle order -------------------
STAGES = ("introduction", "growth", "maturity", "decline")

# --- fixed values: stage rules on monthly signals --------------------------
# introduction if age_ratio < 0.18
# growth       if revenue_change >= 0.12 and avg_sentiment >= 0.15
# maturity     if revenue_change >= -0.18 and sell_through >= 0.42
# decline      otherwise
STAGE_INTRO_MAX_AGE_RATIO = 0.18
STAGE_GROWTH_MIN_REVENUE_CHANGE = 0.12
STAGE_GROWTH_MIN_SENTIMENT = 0.15
STAGE_MATURITY_MIN_REVENUE_CHANGE = -0.18
STAGE_MATURITY_MIN_SELL_THROUGH = 0.42

# --- fixed values: stage from age alone (catalogue planning) ---------------
# introduction < 0.20 <= growth < 0.46 <= maturity < 0.82 <= decline
AGE_STAGE_BOUNDS = (0.20, 0.46, 0.82)

# --- fixed values: risk score ----------------------------------------------
# 18 + 110*max(0,-sentiment_delta) + 70*max(0,-revenue_change)
#    + 95*return_rate + 55*stockout_ratio - 15*max(0,revenue_change)
RISK_BASE = 18.0
RISK_W_SENTIMENT_DROP = 110.0
RISK_W_REVENUE_DROP = 70.0
RISK_W_RETURN_RATE = 95.0
RISK_W_STOCKOUT = 55.0
RISK_W_REVENUE_GAIN = 15.0

# --- fixed values: opportunity score ---------------------------------------
# 22 + 36*max(0,sentiment) + 40*max(0, 0.12 - revenue_change) + min(reviews,400)/20
OPP_BASE = 22.0
OPP_W_SENTIMENT = 36.0
OPP_REVENUE_PIVOT = 0.12
OPP_W_REVENUE = 40.0
OPP_REVIEW_CAP = 400
OPP_REVIEW_DIVISOR = 20.0

SCORE_MIN = 0.0
SCORE_MAX = 100.0

# --- fixed values: risk buckets and the at-risk flag ----------------------
BUCKET_CRITICAL_MIN = 75.0
BUCKET_WATCH_MIN = 55.0
AT_RISK_MIN = 75.0

# --- fixed values: dashboard alerts (first matching rule wins) ------------
ALERT_RISK_MIN = 70.0
ALERT_RISK_HIGH_MIN = 80.0  # ALERT_RISK_MIN + 10
ALERT_RETURN_RATE_MIN = 0.25
ALERT_SENTIMENT_DELTA_MAX = -0.15
ALERT_LIMIT = 10
ALERT_TITLE_RISK = "Risk score threshold breached"
ALERT_TITLE_RETURNS = "Return rate alert"
ALERT_TITLE_SENTIMENT = "Sentiment decline"

# --- fixed values: report sizes -------------------------------------------
TOP_RISK_LIMIT = 25
SUMMARY_TOP_RISK_LIMIT = 12
TRANSITION_LIMIT = 8

# hours in a week: weekly stockout hours / 168 = stockout ratio
HOURS_PER_WEEK = 168.0

# --- fixed values: CSV exports allowed ------------------------------------
EXPORTABLE_MARTS = ("product_risk_scores", "category_health", "monthly_trends")

# Text used where a product has no catalogue row (documented deviation:
# the dashboard intends these defaults, we print them instead of "None").
UNKNOWN_CATEGORY = "Unknown category"
UNKNOWN_PRODUCT = "Unknown"
