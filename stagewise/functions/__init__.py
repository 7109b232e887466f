"""Column-expression functions (all JVM-side, codegen-friendly)."""

from .calendar import age_days, age_ratio, is_launched, month_end, month_key, shift_months
from .formatting import fixed, human_size, iso_date, percent, thousands
from .rounding import clamp, fill_double, fill_value, money_avg, money_sum, round_half_up
from .scoring import (
    age_stage,
    clamp_sentiment,
    is_at_risk,
    lifecycle_stage,
    opportunity_score,
    rating_from_sentiment,
    risk_bucket,
    risk_score,
)

__all__ = [
    "age_days", "age_ratio", "age_stage", "clamp", "clamp_sentiment", "fill_double", "fill_value",
    "fixed", "human_size", "is_at_risk", "is_launched", "iso_date", "lifecycle_stage", "money_avg",
    "money_sum", "month_end", "month_key", "opportunity_score", "percent", "rating_from_sentiment",
    "risk_bucket", "risk_score", "round_half_up", "shift_months", "thousands",
]
