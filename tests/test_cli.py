"""Command line: pipeline, report, export, payload (in-process)."""

from __future__ import annotations

import glob
import json

from stagewise.__main__ import main
from stagewise.plans import dashboard


def test_cli_end_to_end(spark, sf_small, tmp_dir, capsys):
    out = f"{tmp_dir}/marts"
    assert main(["pipeline", "--tables", sf_small, "--out", out], spark=spark) == 0
    printed = capsys.readouterr().out
    assert "product_stage_history" in printed

    assert main(["report", "--marts", out], spark=spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert lines[0] == "Latest month: 2001-11-01" and lines[4] == "Top Risk Products" and len(lines) == 5 + 8

    assert main(["export", "--marts", out, "--table", "category_health", "--dest", f"{tmp_dir}/csv"], spark=spark) == 0
    assert glob.glob(f"{tmp_dir}/csv/part-*.csv")

    assert main(["payload", "--marts", out, "--dest", f"{tmp_dir}/payload", "--raw", sf_small], spark=spark) == 0
    rows = [json.loads(line) for f in glob.glob(f"{tmp_dir}/payload/part-*.json") for line in open(f)]
    sections = {r["section"] for r in rows}
    assert {"ready", "overview", "alerts", "stage_transitions", "filter_options", "raw_zone"} <= sections
    (zone,) = [json.loads(r["row_json"]) for r in rows if r["section"] == "raw_zone"]
    assert zone["raw_file_count"] >= 3 and zone["raw_bytes"] > 0


def test_dashboard_from_stored_marts_equals_direct(spark, sf_small, tmp_dir):
    from stagewise.operators import insights, marts
    from stagewise.plans import pipeline
    from stagewise.plans.registry import m0

    pipeline.run_from_tables(spark, sf_small, tmp_dir)
    stored = dashboard.load_marts(spark, tmp_dir)
    metrics = m0(spark, sf_small)
    direct_alerts = insights.alerts(marts.product_risk_scores(metrics))
    assert [tuple(r) for r in dashboard.dashboard_sections(stored)["alerts"].collect()] == \
        [tuple(r) for r in direct_alerts.collect()]
    direct_tr = insights.stage_transitions(marts.product_stage_history(metrics))
    assert [tuple(r) for r in dashboard.dashboard_sections(stored)["stage_transitions"].collect()] == \
        [tuple(r) for r in direct_tr.collect()]


def test_pipeline_to_jdbc_and_dashboard_from_jdbc(spark, sf_small, tmp_dir):
    import pytest

    from stagewise.plans import pipeline

    url = "jdbc:derby:memory:stagewise_pipeline;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    try:
        spark._jvm.java.lang.Class.forName(props["driver"])
    except Exception:
        pytest.skip("Derby driver not on the classpath")
    paths = pipeline.run_from_tables(spark, sf_small, tmp_dir, jdbc_url=url, jdbc_properties=props)
    assert paths["product_risk_scores"].endswith("#product_risk_scores")
    stored = dashboard.load_marts(spark, jdbc_url=url, jdbc_properties=props)
    assert stored["product_stage_history"].count() == 8404
    assert stored["product_risk_scores"].count() == 8
    assert dashboard.dashboard_sections(stored)["alerts"].count() == 4
    # append inserts again
    pipeline.run_from_tables(spark, sf_small, tmp_dir, mode="append", jdbc_url=url, jdbc_properties=props)
    assert spark.read.jdbc(url, "monthly_trends", properties=props).count() == 2 * 83


def test_missing_marts_give_empty_sections(spark, tmp_dir):
    stored = dashboard.load_marts(spark, f"{tmp_dir}/nothing-here")
    assert all(df.count() == 0 for df in stored.values())
    rows = dashboard.dashboard_payload(stored).collect()
    assert [(r.section, r.row_json) for r in rows if r.section == "ready"] == [("ready", '{"ready":false}')]


def test_overview_after_append_shows_one_row(spark, sf_small, tmp_dir):
    from stagewise.plans import pipeline

    pipeline.run_from_tables(spark, sf_small, tmp_dir)
    pipeline.run_from_tables(spark, sf_small, tmp_dir, mode="append")
    stored = dashboard.load_marts(spark, tmp_dir)
    assert stored["dashboard_overview"].count() == 2
    assert dashboard.dashboard_sections(stored)["overview"].count() == 1
    assert dashboard.summary_report(stored).count() == 5 + 12


def test_module_entry_point_in_fresh_process(sf_small, tmp_dir):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root)
    run = subprocess.run(
        [sys.executable, "-m", "stagewise", "--master", "local[2]", "pipeline", "--tables", sf_small,
         "--out", f"{tmp_dir}/cli"],
        capture_output=True, text=True, timeout=600, env=env, cwd=tmp_dir,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert "dashboard_overview" in run.stdout
    assert glob.glob(f"{tmp_dir}/cli/product_stage_history/_data/*/part-*.parquet")


def test_cli_refresh_then_report(spark, sf_small, tmp_dir, capsys):
    from stagewise.plans.registry import write_raw_zone

    raw = write_raw_zone(spark, sf_small, f"{tmp_dir}/raw")
    args = ["refresh", "--raw", raw, "--state", f"{tmp_dir}/state", "--out", f"{tmp_dir}/out",
            "--max-files-per-trigger", "50", "--compact"]
    assert main(args, spark=spark) == 0
    assert glob.glob(f"{tmp_dir}/state/compacted/upto=*")
    capsys.readouterr()
    assert main(["report", "--marts", f"{tmp_dir}/out"], spark=spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert lines[0] == "Latest month: 2001-11-01" and len(lines) == 5 + 8


def test_payload_positions_follow_list_order(spark, sf_small):
    from stagewise.operators import insights, marts
    from stagewise.plans.registry import QUERIES, m0

    rows = QUERIES["payload_rows_json"](spark, sf_small).collect()
    by_section: dict[str, list] = {}
    for r in rows:
        by_section.setdefault(r.section, []).append((r.position, json.loads(r.row_json)))
    ordered = {k: [obj for _, obj in sorted(v, key=lambda t: t[0])] for k, v in by_section.items()}
    assert all(p is not None for v in by_section.values() for p, _ in v)
    for k, v in by_section.items():
        assert sorted(p for p, _ in v) == list(range(1, len(v) + 1)), k

    months = [o["month"] for o in ordered["monthly_trends"]]
    assert months == sorted(months)
    risk = [(o["risk_score"], o["revenue"]) for o in ordered["product_risk_scores"]]
    assert risk == sorted(risk, key=lambda t: (-t[0], -t[1]))
    metrics = m0(spark, sf_small)
    history, top = marts.product_stage_history(metrics), marts.product_risk_scores(metrics)
    assert [tuple(o.values()) for o in ordered["alerts"]] == [tuple(r) for r in insights.alerts(top).collect()]
    assert [tuple(o.values()) for o in ordered["stage_transitions"]] == \
        [tuple(r) for r in insights.stage_transitions(history).collect()]
    assert [(o["option"], o["value"]) for o in ordered["filter_options"]] == \
        [tuple(r) for r in insights.filter_options(history, top).collect()]


def test_payload_keeps_null_fields(spark, tmp_dir):
    rows = dashboard.dashboard_payload(dashboard.load_marts(spark, f"{tmp_dir}/nothing")).collect()
    (default,) = [json.loads(r.row_json) for r in rows if r.section == "filter_options"
                  and json.loads(r.row_json)["option"] == "default_month"]
    assert default == {"option": "default_month", "value": None}
