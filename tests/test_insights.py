"""Alerts, stage transitions, filter options and the summary report."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stagewise import schemas as SC
from stagewise.operators import insights, marts
from stagewise.plans.registry import m0 as build_m0

D = dt.date(2024, 5, 1)


def _risk_row(pid, name, cat, risk, rr=0.0, sd=0.0, revenue=100.0):
    return (pid, name, cat, "b", D, "decline", "watch", risk, 50.0, revenue, 0.0, sd, rr, 0.0)


def test_alert_rules_first_match(spark):
    rows = [
        _risk_row("P01", "Lamp", None, 85.0),
        _risk_row("P02", "Desk", "home", 72.04),
        _risk_row("P03", "Sofa", "home", 60.0, rr=0.3),
        _risk_row("P04", "", "home", 50.0, rr=0.1, sd=-0.2),
        _risk_row("P05", "Mat", "home", 40.0, rr=0.1, sd=-0.1),
        _risk_row("P06", "Cup", "kitchen", 69.99, rr=0.25, sd=-0.15),
    ]
    df = spark.createDataFrame(rows, SC.MARTS["product_risk_scores"])
    got = [tuple(r) for r in insights.alerts(df).collect()]
    assert got == [
        ("Risk score threshold breached", "Lamp", "high", "Unknown category · decline · Risk 85.0 in 2024-05-01"),
        ("Risk score threshold breached", "Desk", "medium", "home · decline · Risk 72.0 in 2024-05-01"),
        ("Return rate alert", "Cup", "medium", "Return rate 25.0% · kitchen · 2024-05-01"),
        ("Return rate alert", "Sofa", "medium", "Return rate 30.0% · home · 2024-05-01"),
        ("Sentiment decline", "P04", "low", "Sentiment Δ -0.200 · home · 2024-05-01"),
    ]


def test_alerts_stop_at_ten(spark):
    rows = [_risk_row(f"P{i:02d}", f"N{i}", "c", 90.0 - i) for i in range(14)]
    df = spark.createDataFrame(rows, SC.MARTS["product_risk_scores"])
    got = insights.alerts(df).collect()
    assert len(got) == 10 and got[0].metric == "N0" and got[-1].metric == "N9"


# --- brute force over the sf0.001 fixture ------------------------------------

@pytest.fixture(scope="module")
def tables(spark, sf_small):
    metrics = build_m0(spark, sf_small)
    history = marts.product_stage_history(metrics)
    risk = marts.product_risk_scores(metrics)
    return metrics, history, risk


def _transitions_brute(history_rows, limit=8):
    ordered = sorted(history_rows, key=lambda r: (r.month, r.product_id))
    by_product: dict[str, list] = {}
    for r in ordered:
        by_product.setdefault(r.product_id, []).append(r)
    counts: Counter = Counter()
    for rows in by_product.values():
        rows = sorted(rows, key=lambda r: r.month)
        for a, b in zip(rows, rows[1:]):
            counts[(a.lifecycle_stage, b.lifecycle_stage)] += 1
    return [(a, b, n) for (a, b), n in counts.most_common(limit)]


def test_transitions_match_brute_force(tables):
    _, history, _ = tables
    rows = history.select("product_id", "month", "lifecycle_stage").collect()
    got = [tuple(r) for r in insights.stage_transitions(history).collect()]
    assert got == _transitions_brute(rows)
    assert len(got) == 8


def test_transitions_tie_break(spark):
    rows = [
        ("P2", dt.date(2024, 1, 1), "introduction"), ("P2", dt.date(2024, 2, 1), "growth"),
        ("P3", dt.date(2024, 1, 1), "decline"), ("P3", dt.date(2024, 2, 1), "decline"),
        ("P1", dt.date(2024, 2, 1), "growth"), ("P1", dt.date(2024, 3, 1), "decline"),
    ]
    df = spark.createDataFrame(rows, "product_id string, month date, lifecycle_stage string")
    got = [tuple(r) for r in insights.stage_transitions(df, limit=3).collect()]
    assert got == _transitions_brute(df.collect(), 3)
    assert got[0][:2] == ("introduction", "growth")


def test_alerts_match_brute_force(tables):
    _, _, risk = tables
    rows = risk.collect()
    ordered = sorted(rows, key=lambda r: (-r.risk_score, -r.revenue, r.product_id))
    want = []
    for r in ordered:
        if len(want) >= 10:
            break
        cat = r.category if r.category is not None else "Unknown category"
        name = r.product_name or r.product_id
        if r.risk_score >= 70:
            want.append(("Risk score threshold breached", name, "high" if r.risk_score >= 80 else "medium",
                         f"{cat} · {r.lifecycle_stage} · Risk {r.risk_score:.1f} in {r.month.isoformat()}"))
        elif r.return_rate >= 0.25:
            want.append(("Return rate alert", name, "medium",
                         f"Return rate {r.return_rate:.1%} · {cat} · {r.month.isoformat()}"))
        elif r.sentiment_delta <= -0.15:
            want.append(("Sentiment decline", name, "low",
                         f"Sentiment Δ {r.sentiment_delta:.3f} · {cat} · {r.month.isoformat()}"))
    got = [tuple(r) for r in insights.alerts(risk).collect()]
    assert got == want


def test_filter_options(tables):
    _, history, risk = tables
    rows = [tuple(r) for r in insights.filter_options(history, risk).collect()]
    opts: dict[str, list] = {}
    for o, v in rows:
        opts.setdefault(o, []).append(v)
    h = history.collect()
    assert opts["months"] == sorted({r.month.isoformat() for r in h}, reverse=True)
    assert opts["categories"] == sorted({r.category for r in h if r.category})
    assert opts["brands"] == sorted({r.brand for r in h if r.brand})
    assert opts["lifecycle_stages"] == ["introduction", "growth", "maturity", "decline"]
    assert opts["risk_buckets"] == sorted({r.risk_bucket for r in risk.collect()})
    assert opts["default_month"] == [opts["months"][0]]


def test_project_summary(tables):
    _, history, _ = tables
    (r,) = insights.project_summary(history).collect()
    h = history.collect()
    assert r.product_count == len({x.product_id for x in h}) and r.month_count == len({x.month for x in h})


def test_summary_report(tables):
    metrics, _, risk = tables
    overview = marts.dashboard_overview(metrics)
    lines = [tuple(r) for r in insights.summary_report(overview, risk).orderBy("line_no").collect()]
    (ov,) = overview.collect()
    assert lines[0] == (1, f"Latest month: {ov.latest_month.isoformat()}")
    assert lines[1] == (2, f"Active products: {ov.active_products}")
    assert lines[2] == (3, f"Revenue: {ov.revenue:,.0f}")
    assert lines[4] == (5, "Top Risk Products")
    n = min(12, risk.count())
    assert len(lines) == 5 + n and [k for k, _ in lines] == list(range(1, 6 + n))
    top = sorted(risk.collect(), key=lambda r: (-r.risk_score, -r.revenue, r.product_id))[0]
    assert lines[5][1].startswith(f"{top.product_name or 'Unknown'} | Risk {top.risk_score:.1f} | Returns ")


def test_summary_report_lists_twelve_of_more(spark, tables):
    metrics, _, _ = tables
    rows = [_risk_row(f"P{k}", f"Name{k}", "c", float(k) + 0.35) for k in range(20)]
    risk = spark.createDataFrame(rows, SC.MARTS["product_risk_scores"])
    lines = [tuple(r) for r in insights.summary_report(marts.dashboard_overview(metrics), risk).orderBy("line_no").collect()]
    assert len(lines) == 5 + 12
    assert [x.split(" | ")[:2] for _, x in lines[5:]] == [[f"Name{k}", f"Risk {k + 0.35:.1f}"] for k in range(19, 7, -1)]


def test_overview_on_empty_table(spark, tables):
    metrics, _, _ = tables
    (r,) = marts.dashboard_overview(metrics.filter(F.lit(False))).collect()
    assert r.latest_month is None and r.active_products == 0


def test_alert_thresholds_at_boundaries(spark):
    rows = [
        _risk_row("P1", "AtHigh", "c", 80.0),
        _risk_row("P2", "AtRisk", "c", 70.0),
        _risk_row("P3", "JustBelow", "c", 69.99, rr=0.2499, sd=-0.1499),
        _risk_row("P4", "AtReturn", "c", 10.0, rr=0.25),
        _risk_row("P5", "AtSentiment", "c", 5.0, sd=-0.15),
    ]
    df = spark.createDataFrame(rows, SC.MARTS["product_risk_scores"])
    got = [(r.metric, r.title, r.severity) for r in insights.alerts(df).collect()]
    assert got == [
        ("AtHigh", "Risk score threshold breached", "high"),
        ("AtRisk", "Risk score threshold breached", "medium"),
        ("AtReturn", "Return rate alert", "medium"),
        ("AtSentiment", "Sentiment decline", "low"),
    ]
