"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line. ``value`` is the end-to-end batch pipeline time
(scored fact table written once + seven marts written), the job a user runs.
Each query in ``queries`` is timed separately by running its full plan into
Spark's ``noop`` sink (no driver collect). ``naive_pipeline`` times the naive
form of the same job (three joins, the fact table computed anew for every
mart) over ``BENCH_NAIVE_REPS`` runs (default: same as BENCH_REPS; 0 skips it).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from stagewise.operators import marts, monthly  # noqa: E402
from stagewise.plans import pipeline  # noqa: E402
from stagewise.plans.registry import QUERIES  # noqa: E402
from stagewise.session import build_session, scratch_path  # noqa: E402
from stagewise.sources import adapters  # noqa: E402

HEADLINE = (
    "monthly_metrics",
    "monthly_fused",
    "monthly_joined",
    "mart_overview",
    "mart_monthly_trends",
    "mart_stage_sentiment",
    "mart_category_health",
    "mart_lifecycle_distribution",
    "mart_product_risk_scores",
    "mart_product_stage_history",
    "stage_transitions",
    "alerts",
    "filter_options",
    "summary_top_risk",
)


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def run_naive(d: dict) -> None:
    """Every mart from the joined fact table, which is computed for each of them."""
    joined = monthly.monthly_joined(d["products"], d["orders"], d["reviews"], d["inventory"])
    for mart in marts.build_marts(monthly.score_monthly(joined)).values():
        mart.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="stagewise-bench",
        shuffle_partitions=cpus,
        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    scratch = scratch_path(spark, "bench")

    def noop(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Warm-up: JVM, parquet footers, code caches.
    noop("monthly_metrics")

    queries = {}
    for name in HEADLINE:
        runs = sorted(timed(lambda n=name: noop(n)) for _ in range(reps))
        queries[name] = round(runs[len(runs) // 2], 3)

    pipe_runs = []
    for i in range(reps):
        out = f"{scratch}/pipeline-{i}"
        pipe_runs.append(timed(lambda o=out: pipeline.run_from_tables(spark, sf_dir, o)))
    pipe_runs.sort()
    pipeline_sec = round(pipe_runs[len(pipe_runs) // 2], 3)
    queries["pipeline_end_to_end"] = pipeline_sec

    naive_reps = int(os.environ.get("BENCH_NAIVE_REPS", str(reps)))
    if naive_reps > 0:
        naive_runs = sorted(timed(lambda: run_naive(adapters.datasets(spark, sf_dir))) for _ in range(naive_reps))
        queries["naive_pipeline"] = round(naive_runs[len(naive_runs) // 2], 3)

    result = {
        "metric": "lifecycle_pipeline_end_to_end",
        "value": pipeline_sec,
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "reps": reps,
        "stat": "median",
    }
    if "naive_pipeline" in queries:
        result["speedup_vs_naive"] = round(queries["naive_pipeline"] / pipeline_sec, 2)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
