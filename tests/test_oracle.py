"""Every registered query against its DuckDB oracle SQL on sf0.001."""

from __future__ import annotations

import pytest

from tests.oracle_check import compare


@pytest.fixture(scope="module")
def results(spark, sf_small):
    from stagewise.plans.registry import QUERIES

    return compare(spark, sf_small, names=list(QUERIES), verbose=False)


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if v.get("ok") is False}
    assert not bad, bad


def test_rows_only_queries_run(results):
    unchecked = {k for k, v in results.items() if v.get("ok") is None}
    assert unchecked == {"raw_zone_inventory", "payload_rows_json"}


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 8404
    assert set(E.oracle_sql()) <= set(E.queries())
