"""Run the fused monthly aggregate on a deliberately skewed input and report
shuffle metrics from Spark's event log (used by tests/test_skew.py).

The skewed input is derived from the given tables: every third sales line is
reassigned to one product, so that product holds about a third of all rows.
Prints one JSON line with input rows, shuffle records written by the map side
of the aggregate, and the largest number of records any reducer read.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str) -> None:
    import zstandard as zstd
    from pyspark.sql import functions as F

    from stagewise.operators import monthly
    from stagewise.session import build_session
    from stagewise.sources import adapters

    ev = tempfile.mkdtemp(prefix="stagewise-skew-ev-")
    spark = build_session(
        "local[4]", shuffle_partitions=8,
        conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
              "spark.sql.adaptive.coalescePartitions.enabled": "false"},
    )
    d = adapters.datasets(spark, sf_dir)
    # several map tasks; every third order's lines go to part 1
    lineitem = adapters._table(spark, sf_dir, "lineitem").repartition(4).withColumn(
        "l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_partkey"))
    )
    sales = adapters.sales(spark, sf_dir, lineitem)
    n_rows = sales.count()
    n_hot = sales.filter(F.substring("product_id", 2, 20).cast("bigint") == 1).count()
    facts = monthly.monthly_facts(sales, d["reviews"].filter(F.lit(False)), d["inventory"].filter(F.lit(False)))
    monthly.monthly_aggregate(facts).write.format("noop").mode("overwrite").save()
    spark.stop()

    (path,) = glob.glob(f"{ev}/*/events*") or glob.glob(f"{ev}/*")
    stages: dict[int, dict] = {}
    with open(path, "rb") as fh:
        stream = zstd.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] != "SparkListenerTaskEnd":
                continue
            m = e.get("Task Metrics") or {}
            st = stages.setdefault(e["Stage ID"], {"written": 0, "read_max": 0, "read_total": 0})
            st["written"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
            r = m.get("Shuffle Read Metrics", {})
            got = r.get("Total Records Read", 0)
            st["read_max"] = max(st["read_max"], got)
            st["read_total"] += got
    # the aggregate's map side is the last stage that writes shuffle records,
    # its reduce side the last stage that reads them
    writers = [s for s in stages.values() if s["written"]]
    readers = [s for s in stages.values() if s["read_total"]]
    print(json.dumps({
        "input_rows": n_rows,
        "hot_rows": n_hot,
        "agg_shuffle_records_written": writers[-1]["written"],
        "agg_max_records_per_reducer": readers[-1]["read_max"],
    }))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
