"""Results do not depend on the caller's session settings (time zone, ANSI)."""

from __future__ import annotations

import pytest

from tests.oracle_check import compare

NAMES = ["src_orders", "src_reviews", "src_inventory", "monthly_metrics", "mart_overview", "alerts",
         "incremental_refresh"]


@pytest.mark.parametrize("tz,ansi", [("America/Los_Angeles", "false"), ("Asia/Kolkata", "true")])
def test_queries_match_oracle_under_other_sessions(spark, sf_small, tz, ansi):
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.session.timeZone", tz)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        res = compare(spark, sf_small, NAMES, verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)
    bad = {k: v for k, v in res.items() if v.get("ok") is not True}
    assert not bad, bad
