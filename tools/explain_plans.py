"""Write the physical plans of selected registered queries to docs/plans.txt.

For each query: the plan tree, the pushed filters / read schema of each scan,
and the number of shuffle exchanges. ``python tools/explain_plans.py [sf_dir]``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stagewise.plans.registry import QUERIES  # noqa: E402
from stagewise.session import build_session  # noqa: E402

SELECTED = (
    "monthly_metrics",
    "monthly_joined",
    "mart_overview",
    "mart_product_risk_scores",
    "stage_transitions",
    "alerts",
    "filter_options",
)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    head = text.split("\n\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan parquet.*?\n(?:.*\n)*?ReadSchema: .*", text)
    lines = [head.strip(), ""]
    for s in scans:
        keep = [ln for ln in s.splitlines() if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
        lines.extend(keep)
    main = text.split("===== Subqueries =====")[0]
    lines.append(f"shuffle exchanges (main plan): {len(re.findall(r'^\(\d+\) Exchange', main, re.M))}")
    lines.append(f"broadcast exchanges (main plan): {len(re.findall(r'^\(\d+\) BroadcastExchange', main, re.M))}")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = [f"Physical plans at {sf} (local[8], AQE on; initial plans before runtime re-planning)\n"]
    for name in SELECTED:
        out.append("=" * 100)
        out.append(f"query: {name}")
        out.append(summarize(formatted(QUERIES[name](spark, sf))))
        out.append("")
    path = os.path.join(ROOT, "docs", "plans.txt")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
