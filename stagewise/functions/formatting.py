"""Number-to-text formatting for alerts and reports, with the digits of Python's ``format``."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import _c

#: Powers of two by which a double is taken apart without rounding.
_LOW, _LIMB = 2**50, 2**52
#: From here on Java's digits are printed.
_LARGEST = 2.0**100


def _integer(col: Column) -> Column:
    """A whole double under 2**53 as an exact decimal."""
    return col.cast("bigint").cast("decimal(38,0)")


def fixed(col: Column | str, decimals: int) -> Column:
    """``f"{x:.Nf}"`` (N up to 6): the exact binary value, rounded half to even.

    The whole part is two integers and the fraction two more of 52 bits each,
    split off by operations that are exact on doubles; the fraction times
    10**N is then divided by 2**104 in DECIMAL. From 2**100 on Java's digits
    are printed, which may differ in places a double does not hold.
    """
    if not 0 <= decimals <= 6:
        raise ValueError("decimals must be 0 to 6")
    x = _c(col).cast("double")
    size = F.abs(x)
    a = F.when(size < F.lit(_LARGEST), size).otherwise(F.lit(0.0))
    fraction = a % F.lit(1.0)
    whole = a - fraction
    low = whole % F.lit(float(_LOW))
    top = (whole - low) / F.lit(float(_LOW))
    first = fraction * F.lit(float(_LIMB))
    rest = first % F.lit(1.0)
    second = rest * F.lit(float(_LIMB))
    scale, unit = F.lit(Decimal(10**decimals)), F.lit(Decimal(_LIMB**2))
    part = (_integer(first - rest) * F.lit(Decimal(_LIMB)) + _integer(second - second % F.lit(1.0))) * scale
    left = part % unit
    down = F.call_function("div", part, unit).cast("decimal(38,0)")
    odd = (down if decimals else _integer(low)) % F.lit(Decimal(2)) == F.lit(Decimal(1))
    half = F.lit(Decimal(_LIMB**2 // 2))
    up = F.when((left > half) | ((left == half) & odd), F.lit(Decimal(1))).otherwise(F.lit(Decimal(0)))
    total = (_integer(top) * F.lit(Decimal(_LOW)) + _integer(low)) * scale + down + up
    digits = total.cast("decimal(38,0)").cast("string")
    if decimals:
        digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(decimals + 1)), F.lit("0"))
        digits = F.concat(F.substr(digits, F.lit(1), F.length(digits) - decimals), F.lit("."), F.right(digits, F.lit(decimals)))
    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("nan"))
        .when(size == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
        .when(size >= F.lit(_LARGEST), F.format_string(f"%.{decimals}f", x))
        .otherwise(F.concat(sign, digits))
    )


def percent(col: Column | str, decimals: int = 1) -> Column:
    """``f"{x:.N%}"``: the value times 100, fixed point, and a percent sign."""
    return F.concat(fixed(_c(col).cast("double") * F.lit(100.0), decimals), F.lit("%"))


def thousands(col: Column | str) -> Column:
    """``f"{x:,.0f}"``."""
    return F.format_number(_c(col).cast("double"), 0)


def iso_date(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def human_size(num_bytes: Column | str) -> Column:
    """Bytes as ``"N B"`` or ``"x.y KB|MB|GB|TB"`` (1024 steps, TB is the top unit)."""
    b = _c(num_bytes).cast("double")
    kib = F.lit(1024.0)

    def unit(power: int, name: str) -> Column:
        return F.concat(fixed(b / F.pow(kib, F.lit(power)), 1), F.lit(f" {name}"))

    return (
        F.when(b < kib, F.concat(b.cast("bigint").cast("string"), F.lit(" B")))
        .when(b < F.pow(kib, F.lit(2)), unit(1, "KB"))
        .when(b < F.pow(kib, F.lit(3)), unit(2, "MB"))
        .when(b < F.pow(kib, F.lit(4)), unit(3, "GB"))
        .otherwise(unit(4, "TB"))
    )
