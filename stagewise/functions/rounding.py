"""Rounding and null-filling helpers shared by every operator.

Averages and ratios are doubles; plain ``round`` on a double that sits on a
tie is rounded differently by different engines. Nudging the value by 1e-9
toward its sign before rounding makes the result engine-independent (it is
HALF_UP on the intended decimal value). ``+ 0.0`` turns ``-0.0`` into ``0.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUND_NUDGE = 1e-9


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col: Column | str, scale: int) -> Column:
    """HALF_UP rounding of a double, stable across engines."""
    c = _c(col)
    return F.round(c + F.signum(c) * F.lit(ROUND_NUDGE), scale) + F.lit(0.0)


def fill_double(col: Column | str, default: float = 0.0) -> Column:
    """``DataFrame.fillna`` semantics for one double column: null and NaN."""
    c = _c(col)
    d = F.lit(float(default))
    return F.coalesce(F.nanvl(c, d), d)


def fill_value(col: Column | str, default) -> Column:
    """``fillna`` for non-floating columns: null only."""
    return F.coalesce(_c(col), F.lit(default))


def clamp(col: Column | str, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _c(col)))


def money_sum(col: Column | str) -> Column:
    """Exact sum of 2-dp money values, returned as a 2-dp double."""
    return F.round(F.sum(_c(col).cast("decimal(18,2)")), 2).cast("double")


def money_avg(col: Column | str) -> Column:
    """Average of 2-dp money values over DECIMAL, then HALF_UP to 2 dp."""
    return round_half_up(F.avg(_c(col).cast("decimal(18,2)")).cast("double"), 2)
