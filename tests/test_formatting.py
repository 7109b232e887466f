"""Number text equals Python's ``format`` on exact ties, random doubles and odd values."""

from __future__ import annotations

import random
import struct

import pytest

from stagewise.functions.formatting import fixed, human_size, percent


def _texts(spark, values, *columns):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x double")
    return [tuple(r)[1:] for r in df.select("k", *columns).orderBy("k").collect()]


@pytest.mark.parametrize("decimals", [0, 1, 2, 3, 6])
def test_random_doubles(spark, decimals):
    draw = random.Random(decimals)
    values = [draw.uniform(-100, 100) for _ in range(4000)] + [draw.uniform(0, 1e15) for _ in range(500)]
    while len(values) < 10_000:  # any exponent and mantissa under 2**100
        x = struct.unpack("<d", draw.randbytes(8))[0]
        if abs(x) < 2.0**100:
            values.append(x)
    assert [t for (t,) in _texts(spark, values, fixed("x", decimals))] == [f"{x:.{decimals}f}" for x in values]


def test_ties_of_two_decimals(spark):
    values = [k / 100 for k in range(-10_100, 10_101)] + [k / 8 for k in range(-99, 100)]
    got = _texts(spark, values, fixed("x", 1), fixed("x", 0), fixed("x", 2))
    assert got == [(f"{x:.1f}", f"{x:.0f}", f"{x:.2f}") for x in values]
    assert dict(zip(values, got, strict=True))[88.35][0] == "88.3"


def test_percent_of_rates(spark):
    values = [k / 10_000 for k in range(0, 10_001, 3)] + [0.2545, 0.0005, 1 / 3]
    assert [t for (t,) in _texts(spark, values, percent("x", 1))] == [f"{x:.1%}" for x in values]


def test_odd_values(spark):
    values = [0.0, -0.0, -0.04, 0.05, 0.25, 5e-324, float("nan"), float("inf"), float("-inf"), None, 2.0**53 + 2, 2.0**99, 1e300]
    got = [t for (t,) in _texts(spark, values, fixed("x", 1))]
    assert got[:9] == [f"{x:.1f}" for x in values[:9]]
    assert got[9] is None and got[10:12] == [f"{x:.1f}" for x in values[10:12]] and got[12].startswith("1000")
    with pytest.raises(ValueError):
        fixed("x", 7)


def test_readable_sizes(spark):
    values = [0.0, 1023.0, 1024.0, 1075.2, 1177.6, 1024.0**2 * 1.25, 1024.0**4 * 3000]
    got = [t for (t,) in _texts(spark, values, human_size("x"))]
    assert got == ["0 B", "1023 B", "1.0 KB", f"{1075.2 / 1024:.1f} KB", f"{1177.6 / 1024:.1f} KB", "1.2 MB", "3000.0 TB"]
