"""Zone maps of the raw zone: files chosen by the months and products of their rows."""

from __future__ import annotations

import datetime as dt
import json
import os
from urllib.parse import unquote

import pytest

from stagewise.__main__ import main
from stagewise.operators import monthly
from stagewise.plans import pipeline
from stagewise.plans.registry import inputs, write_raw_zone
from stagewise.sources import jsonl, zone_map


def _lines(path: str, rows: list[dict | str]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
    return path


def _order(product: str | None, ts: str | None) -> dict:
    return {"product_id": product, "order_ts": ts, "quantity": 1, "unit_price": 2.5, "discount_pct": 0}


@pytest.fixture
def root(tmp_dir):
    """Three months; a row of January lies in the folder of March, and a file holds no readable month."""
    r = f"{tmp_dir}/raw zone"
    _lines(f"{r}/orders/year=2024/month=01/a.jsonl", [_order("P1", "2024-01-05"), _order("P2", "2024-01-31T23:59:59")])
    _lines(f"{r}/orders/year=2024/month=02/b[1].jsonl", [_order("P5", "2024-02-01T00:00:00"), _order(None, "2024-02-09")])
    _lines(f"{r}/orders/year=2024/month=03/c.jsonl", [_order("P1", "2024-03-02"), _order("P9", "2024-01-09")])
    _lines(f"{r}/orders/year=2024/month=03/bad.jsonl", [_order("P1", "never"), "{no json"])
    return r


def _found(df) -> list[tuple]:
    return sorted((r.product_id or "", str(r.order_ts)) for r in df.collect())


def _full(spark, root, first=None, last=None) -> list[tuple]:
    rows = _found(jsonl.read_dataset(spark, root, "orders").where("order_ts IS NOT NULL"))
    return [r for r in rows if (first or "") <= r[1][:7] <= (last or "9")]


def _names(files) -> list[str]:
    return sorted(os.path.basename(unquote(f)) for f in files)


def test_only_files_with_the_months_are_opened(spark, root):
    assert zone_map.update_map(spark, root, "orders") == 4
    for first, last, files in [
        ("2024-01", "2024-01", ["a.jsonl", "c.jsonl"]),
        ("2024-02", "2024-02", ["b[1].jsonl", "c.jsonl"]),
        ("2024-03", None, ["c.jsonl"]),
        (None, "2023-12", []),
        ("2024-04", None, []),
    ]:
        assert _names(zone_map.chosen_files(spark, root, "orders", first, last)) == files
        df = zone_map.read_zoned(spark, root, "orders", first, last)
        assert _names(df.inputFiles()) == files
        assert _found(df) == _full(spark, root, first, last)
        assert _found(zone_map.read_zoned(spark, root, "orders", first, last, complete=True)) == _found(df)
    assert zone_map.last_month(spark, root) == "2024-03"
    # without bounds every row comes, unreadable ones too
    assert zone_map.read_zoned(spark, root, "orders").count() == 8


def test_products_choose_files(spark, root):
    zone_map.update_map(spark, root, "orders")
    df = zone_map.read_zoned(spark, root, "orders", first_product="P5", last_product="P6")
    # c holds P1 and P9: P5 may lie between, its rows say it doesn't
    assert _names(df.inputFiles()) == ["b[1].jsonl", "c.jsonl"]
    assert [r.product_id for r in df.collect()] == ["P5"]


def test_map_rows(spark, root):
    zone_map.update_map(spark, root, "orders")
    rows = {_names([r.file])[0]: r for r in zone_map.read_map(spark, root, "orders").collect()}
    c, bad = rows["c.jsonl"], rows["bad.jsonl"]
    assert (c.first_month, c.last_month) == (dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    assert (c.first_product, c.last_product, c.n_rows) == ("P1", "P9", 2)
    assert (bad.first_month, bad.last_month, bad.n_rows) == (None, None, 2)
    assert rows["b[1].jsonl"].first_product == "P5"


def test_new_changed_and_deleted_files(spark, root):
    # no map at all: everything is read
    assert _found(zone_map.read_zoned(spark, root, "orders", "2024-02", "2024-02")) == _full(spark, root, "2024-02", "2024-02")
    zone_map.update_map(spark, root, "orders")
    new = _lines(f"{root}/orders/year=2024/month=03/late.jsonl", [_order("P3", "2024-02-20")])
    _lines(f"{root}/orders/year=2024/month=01/a.jsonl", [_order("P1", "2024-01-05"), _order("P2", "2024-02-28"), _order("P7", "2024-02-11")])
    want = _full(spark, root, "2024-02", "2024-02")
    assert len(want) == 5
    # not in the map yet, or not any more as they were: read whole
    assert _found(zone_map.read_zoned(spark, root, "orders", "2024-02", "2024-02")) == want
    assert zone_map.update_map(spark, root, "orders") == 2
    assert zone_map.update_map(spark, root, "orders") == 0
    assert _found(zone_map.read_zoned(spark, root, "orders", "2024-02", "2024-02")) == want
    os.unlink(new)
    assert _found(zone_map.read_zoned(spark, root, "orders", "2024-02", "2024-02")) == [w for w in want if w[0] != "P3"]
    assert zone_map.update_map(spark, root, "orders") == 0
    assert zone_map.read_map(spark, root, "orders").count() == 4


def test_a_bad_month_is_refused(spark, root):
    with pytest.raises(ValueError):
        zone_map.read_zoned(spark, root, "orders", "2024-13")


def test_one_month_pipeline(spark, sf_small, tmp_dir):
    root = write_raw_zone(spark, sf_small, f"{tmp_dir}/raw")
    assert main(["zones", "--raw", root], spark=spark) == 0
    data = inputs(spark, sf_small)
    month = zone_map.last_month(spark, root)
    for name, df in zone_map.read_months(spark, root, month, month).items():
        files = df.inputFiles()
        if name != "products":
            y, m = month.split("-")
            assert all(f"year={y}/month={m}/" in f for f in files)
    out = f"{tmp_dir}/out"
    assert main(["pipeline", "--raw", root, "--out", out, "--first-month", month, "--last-month", month], spark=spark) == 0
    got = pipeline.read_fact_table(spark, out)
    inside = {
        n: df if n == "products" else df.where(f"date_format({zone_map.EVENT_TIME[n]}, 'yyyy-MM') = '{month}'")
        for n, df in data.items()
    }
    want = monthly.monthly_metrics(inside["products"], inside["orders"], inside["reviews"], inside["inventory"])
    assert got.count() > 0
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and want.select(*got.columns).exceptAll(got).isEmpty()
