"""Monthly fact table semantics on tiny hand-built data (gap months,
review-only months, orphans, pre-launch activity, NaN fill)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise import schemas as SC
from stagewise.operators import monthly

D = dt.date
TS = dt.datetime


@pytest.fixture(scope="module")
def data(spark):
    products = spark.createDataFrame(
        [
            ("A", "Alpha", "toys", "acme", D(2024, 1, 15), 1.0, 10, 300, 0.1),
            ("C", "Gamma", "toys", "acme", D(2024, 6, 1), 1.0, 10, 400, 0.1),
            ("D", "Delta", "home", "zen", D(2023, 1, 1), 1.0, 10, 0, 0.1),
        ],
        SC.PRODUCTS,
    )
    orders = spark.createDataFrame(
        [
            ("A", TS(2024, 1, 3, 10), 1, Decimal("10.00"), Decimal("0.00"), False),
            ("A", TS(2024, 1, 20, 12), 2, Decimal("10.00"), Decimal("0.10"), True),
            ("A", TS(2024, 4, 2), 1, Decimal("14.00"), Decimal("0.00"), None),
            ("B", TS(2024, 3, 9), 1, Decimal("5.55"), Decimal("0.00"), False),
            ("C", TS(2024, 3, 31, 23, 59), 3, Decimal("1.00"), Decimal("0.00"), False),
        ],
        SC.ORDERS,
    )
    reviews = spark.createDataFrame(
        [
            ("A", TS(2024, 1, 5), 4, 0.2),
            ("A", TS(2024, 1, 6), 5, 0.3),
            ("A", TS(2024, 2, 1), 3, 0.1),
        ],
        SC.REVIEWS,
    )
    inventory = spark.createDataFrame(
        [
            ("A", D(2024, 1, 1), 10, 10.0, 0.5),
            ("A", D(2024, 1, 8), 20, 20.0, 0.6),
            ("D", D(2024, 2, 1), 5, float("nan"), 0.3),
        ],
        SC.INVENTORY,
    )
    return products, orders, reviews, inventory


@pytest.fixture(scope="module")
def m0(data):
    rows = monthly.monthly_metrics(*data).collect()
    return {(r.product_id, r.month): r for r in rows}


def test_keys_are_activity_months(m0):
    assert sorted(m0) == sorted([
        ("A", D(2024, 1, 1)), ("A", D(2024, 2, 1)), ("A", D(2024, 4, 1)),
        ("B", D(2024, 3, 1)), ("C", D(2024, 3, 1)), ("D", D(2024, 2, 1)),
    ])


def test_first_month_measures(m0):
    r = m0[("A", D(2024, 1, 1))]
    assert (r.units_sold, r.revenue, r.order_count, r.returned_orders) == (3, 28.0, 2, 1)
    assert (r.avg_rating, r.avg_sentiment, r.review_count) == (4.5, 0.25, 2)
    assert (r.avg_stock_on_hand, r.avg_stockout_hours, r.sell_through_pct) == (15.0, 15.0, 0.55)
    assert r.return_rate == 0.5
    assert r.stockout_ratio == 0.0893
    assert r.revenue_change == 0.0 and r.sentiment_delta == 0.0  # first row of the product
    assert r.age_days == 16
    assert r.lifecycle_stage == "introduction"


def test_review_only_month_zero_filled(m0):
    r = m0[("A", D(2024, 2, 1))]
    assert (r.revenue, r.units_sold, r.order_count, r.return_rate) == (0.0, 0, 0, 0.0)
    assert r.revenue_change == -1.0  # 0 / 28 - 1
    assert r.sentiment_delta == pytest.approx(-0.15)
    assert r.avg_stock_on_hand == 0.0 and r.sell_through_pct == 0.0


def test_lag_is_previous_existing_row(m0):
    # April follows February (no March row): previous revenue is 0 -> change 0.
    r = m0[("A", D(2024, 4, 1))]
    assert r.revenue == 14.0 and r.revenue_change == 0.0
    assert r.avg_sentiment == 0.0 and r.sentiment_delta == pytest.approx(-0.1)
    assert r.return_rate == 0.0  # NULL returned flag is not a return


def test_orphan_product(m0):
    r = m0[("B", D(2024, 3, 1))]
    assert r.product_name is None and r.category is None
    assert r.age_days is None and r.age_ratio is None
    assert r.lifecycle_stage == "introduction"
    assert r.revenue == 5.55


def test_activity_before_launch(m0):
    r = m0[("C", D(2024, 3, 1))]
    assert r.age_days == -62 and r.age_ratio < 0
    assert r.lifecycle_stage == "introduction"


def test_nan_and_zero_expected_life(m0):
    r = m0[("D", D(2024, 2, 1))]
    assert r.avg_stockout_hours == 0.0 and r.stockout_ratio == 0.0  # NaN filled like fillna
    assert r.age_ratio is None  # expected life of 0 days -> no ratio
    assert r.lifecycle_stage == "introduction"


def test_fused_equals_joined(data):
    fused = monthly.monthly_fused(*data)
    joined = monthly.monthly_joined(*data).select(*fused.columns)
    assert fused.exceptAll(joined).count() == 0
    assert joined.exceptAll(fused).count() == 0


def test_schema(data):
    SC.assert_schema(monthly.monthly_metrics(*data), SC.MONTHLY_METRICS)


def test_current_rows_and_latest(data):
    m = monthly.monthly_metrics(*data)
    assert monthly.latest_month(m).collect()[0][0] == D(2024, 4, 1)
    assert [(r.product_id, r.month) for r in monthly.current_rows(m).collect()] == [("A", D(2024, 4, 1))]


def test_empty_inputs(spark, data):
    products, orders, reviews, inventory = data
    empty = [df.filter(F.lit(False)) for df in (orders, reviews, inventory)]
    m = monthly.monthly_metrics(products, *empty)
    assert m.count() == 0
    assert monthly.latest_month(m).collect()[0][0] is None


def test_catalog_duplicates_fan_out_and_report(spark, data):
    from stagewise.operators import quality

    products, orders, reviews, inventory = data
    dup = products.unionByName(products.filter(F.col("product_id") == "A"))
    assert [tuple(r) for r in quality.catalog_duplicates(dup).collect()] == [("A", 2)]
    # the left join repeats A's monthly rows once per catalogue copy
    m = monthly.monthly_metrics(dup, orders, reviews, inventory)
    assert m.filter(F.col("product_id") == "A").count() == 6


def test_orphan_report(data):
    from stagewise.operators import quality

    m = monthly.monthly_metrics(*data)
    rows = [tuple(r) for r in quality.orphan_products(m, data[0]).collect()]
    assert rows == [("B", D(2024, 3, 1), D(2024, 3, 1), 1, 5.55)]
    # a catalogue row with empty attributes is no orphan
    bare = data[0].limit(1).select(*[
        F.lit("B").alias(f.name) if f.name == "product_id" else F.lit(None).cast(f.dataType).alias(f.name)
        for f in data[0].schema
    ])
    known = data[0].unionByName(bare)
    m = monthly.monthly_metrics(known, *data[1:])
    assert m.filter("product_id = 'B' AND product_name IS NULL").count() == 1
    assert quality.orphan_products(m, known).count() == 0


def test_stockout_ratio_not_clamped(spark):
    products = spark.createDataFrame([("Z", "Zed", "c", "b", D(2020, 1, 1), 1.0, 1, 500, 0.0)], SC.PRODUCTS)
    empty_o = spark.createDataFrame([], SC.ORDERS)
    empty_r = spark.createDataFrame([], SC.REVIEWS)
    inv = spark.createDataFrame([("Z", D(2024, 1, 1), 1, 400.0, 0.5), ("Z", D(2024, 1, 8), 1, 300.0, 0.5)],
                                SC.INVENTORY)
    (r,) = monthly.monthly_metrics(products, empty_o, empty_r, inv).collect()
    assert r.avg_stockout_hours == 350.0 and r.stockout_ratio == round(350.0 / 168.0, 4) > 2.0
    # the score is clamped (18 + 2.0833 * 55 > 100), the ratio is not
    assert r.risk_score == 100.0


def test_latest_month_from_the_sources_equals_the_fact_table(spark, sf_small):
    from stagewise.sources import adapters

    d = adapters.datasets(spark, sf_small)
    sources = (d["orders"], d["reviews"], d["inventory"])
    latest = monthly.latest_activity_month(*sources)
    m0 = monthly.monthly_metrics(d["products"], *sources)
    assert latest.collect() == monthly.latest_month(m0).collect()
    assert monthly.current_rows(m0, latest).count() == monthly.current_rows(m0).count() > 0
    # a NULL product's month counts, a NULL date doesn't; nothing at all gives NULL
    odd = d["reviews"].limit(2).withColumn("product_id", F.lit(None).cast("string")).withColumn(
        "review_ts", F.when(F.col("product_id").isNull(), F.lit("2031-05-06 07:08:09").cast("timestamp_ntz")))
    odd = odd.unionByName(odd.withColumn("review_ts", F.lit(None).cast("timestamp_ntz")))
    got = monthly.latest_activity_month(d["orders"], odd, d["inventory"]).first()[0]
    assert got == monthly.latest_month(monthly.monthly_metrics(d["products"], d["orders"], odd, d["inventory"])).first()[0]
    assert str(got) == "2031-05-01"
    assert monthly.latest_activity_month(*[x.limit(0) for x in sources]).collect()[0][0] is None
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity:" not in plan and "l_extendedprice:" not in plan  # in no ReadSchema
