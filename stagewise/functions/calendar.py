"""Month keys and product age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import _c


def month_key(ts: Column | str) -> Column:
    """First day of the month of a timestamp/date, as DATE."""
    return F.to_date(F.date_trunc("month", _c(ts)))


def month_end(month: Column | str) -> Column:
    return F.last_day(_c(month))


def shift_months(month: Column | str, delta: int | Column) -> Column:
    """First day of the month ``delta`` months away from ``month``."""
    m = F.trunc(_c(month), "month")
    return F.add_months(m, delta)


def age_days(month: Column | str, launch_date: Column | str) -> Column:
    """Days from launch to the last day of the month (negative before launch)."""
    return F.datediff(month_end(month), _c(launch_date))


def age_ratio(age: Column | str, expected_lifecycle_days: Column | str) -> Column:
    """Share of the expected life used; null when the expectation is 0/null."""
    return F.try_divide(_c(age).cast("double"), _c(expected_lifecycle_days).cast("double"))


def is_launched(launch_date: Column | str, month: Column | str) -> Column:
    """Product launched on or before the end of ``month``."""
    return _c(launch_date) <= month_end(month)
