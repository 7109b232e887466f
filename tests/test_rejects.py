"""Every raw value that typing turns into NULL is listed once, with its file."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from stagewise.sources import jsonl, rejects

BAD = ["", "x", "12x", "2024-13-40", "1e999999", "tru", "--1", " ", "99999999999999999999", "NaN", "2024-01-05", "true", "7", "7.9", "0.25"]


@pytest.fixture
def zone(tmp_dir):
    for name in jsonl.DATASETS:
        os.makedirs(f"{tmp_dir}/{name}/year=2024/month=01")
        fields = jsonl.raw_schema(name).fieldNames()
        for file in ("a", "b"):
            with open(f"{tmp_dir}/{name}/year=2024/month=01/{file}.jsonl", "w", encoding="utf-8") as fh:
                for k, value in enumerate(BAD):
                    fh.write(json.dumps(dict.fromkeys(fields, value) if k % 2 else {f: value for f in fields[1:]}) + "\n")
                fh.write(json.dumps(dict.fromkeys(fields)) + "\n{\"product_id\": \n")
    return tmp_dir


@pytest.mark.parametrize("name", jsonl.DATASETS)
def test_every_lost_value_is_listed(spark, zone, tmp_path, name):
    done = rejects.split_dataset(spark, zone, name, str(tmp_path))
    rows = rejects.read_rows(spark, str(tmp_path), name)
    plain = jsonl.read_dataset(spark, zone, name)
    assert rows.schema == plain.schema
    assert rows.exceptAll(plain).count() == 0 and plain.exceptAll(rows).count() == 0
    raw = jsonl.read_json_tree(spark, jsonl.dataset_path(zone, name), jsonl.raw_schema(name))
    raw = raw.select("*", *[c.alias(f"typed_{n}") for n, c in jsonl.typed_columns(name, raw).items()])
    want = []
    for r in raw.collect():
        want += [(f, r[f]) for f in jsonl.raw_schema(name).fieldNames() if r[f] is not None and r[f"typed_{f}"] is None]
    got = rejects.read_rejects(spark, str(tmp_path), name).collect()
    assert sorted((r.field, r.value) for r in got if r.field != rejects.CORRUPT) == sorted(want) and want
    assert [(r.value, r.reason) for r in got if r.field == rejects.CORRUPT] == [('{"product_id": ', rejects.NOT_JSON)] * 2
    assert {os.path.basename(r.file) for r in got} == {"a.jsonl", "b.jsonl"} and {r.dataset for r in got} == {name}
    assert (done.rows, done.rejects) == (plain.count(), len(got))
    assert spark.read.parquet(done.rejects_path).count() == len(got)


def test_one_scan_writes_both(spark, zone):
    plan = rejects.read_checked(spark, zone, "orders")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "BatchEvalPython" not in plan


def test_clean_rows_have_no_rejects(spark, tmp_path):
    os.makedirs(f"{tmp_path}/raw/orders")
    with open(f"{tmp_path}/raw/orders/a.jsonl", "w", encoding="utf-8") as fh:
        fh.write('{"product_id": "P", "order_ts": "2024-01-01T00:00:00Z", "quantity": 2, "unit_price": 1.5, "discount_pct": 0, "returned_flag": true}\n')
    done = rejects.split_dataset(spark, f"{tmp_path}/raw", "orders", f"{tmp_path}/out")
    assert (done.rows, done.rejects) == (1, 0)
    assert rejects.read_rejects(spark, f"{tmp_path}/out", "orders").agg(F.count("*")).first()[0] == 0
