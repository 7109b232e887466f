"""A product holding a third of all rows does not land on one reducer.

Runs tests/skew_probe.py in its own JVM (it needs an event log) on a skewed
input derived from the sf0.01 tables and checks the shuffle metrics of the
fused monthly aggregate.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not available")
def test_hot_product_is_pre_aggregated_before_the_shuffle():
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "skew_probe.py"), SF],
        capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()[-1]
    m = json.loads(out)
    assert m["hot_rows"] * 3.5 >= m["input_rows"]  # the hot product holds about a third of the rows
    # map-side partial aggregation: fewer records shuffled than rows read ...
    assert m["agg_shuffle_records_written"] < m["input_rows"]
    # ... and no reducer receives the hot product's rows
    assert m["agg_max_records_per_reducer"] * 4 < m["hot_rows"]
