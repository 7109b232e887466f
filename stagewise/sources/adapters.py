"""Derive the four lifecycle datasets from the TPC-H-style parquet tables.

The same expressions exist as SQL for the DuckDB oracle (``stagewise_oracle/sql.py``).
Each adapter reads only the columns it needs.

Mapping (fixed values of the test fixture):
  * one product per ``part`` row; every line item belongs to its own part;
  * sales = line items; reviews = line items dated by their order; inventory
    snapshots = line items. No row of a table is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values of the fixture mapping -----------------------------------
LAUNCH_EPOCH = "1994-06-01"
PRODUCT_ID_DIGITS = 12


# Declared read schemas (only the columns the adapters use): no schema
# inference job per table, and the scan reads nothing else.
TABLE_SCHEMAS = {
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pid(key: str) -> str:
    return f"concat('P', lpad(cast({key} as string), {PRODUCT_ID_DIGITS}, '0'))"


# The projections below are the FIXTURES.md expressions, as SQL text.

def products(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    part = part if part is not None else _table(spark, sf_dir, "part")
    return part.selectExpr(
        f"{_pid('p_partkey')} AS product_id",
        "p_name AS product_name",
        "lower(p_type) AS category",
        "p_brand AS brand",
        f"cast(cast('{LAUNCH_EPOCH}' as date) + cast((p_partkey * 37) % 2600 as int) as date) AS launch_date",
        "cast(800 + p_size * 28 as int) AS expected_lifecycle_days",
    )


def sales(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    li = lineitem if lineitem is not None else _table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        f"{_pid('l_partkey')} AS product_id",
        "l_shipdate AS order_ts",
        "cast(l_quantity as int) AS quantity",
        "cast(cast((cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)) as decimal(12,0))"
        " * cast(0.01 as decimal(3,2)) as decimal(14,2)) AS unit_price",
        "cast(l_discount as decimal(4,2)) AS discount_pct",
        "(l_returnflag = 'R' AND l_orderkey % 4 = 0) AS returned_flag",
    )


def reviews(
    spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None, orders: DataFrame | None = None
) -> DataFrame:
    li = lineitem if lineitem is not None else _table(spark, sf_dir, "lineitem")
    od = orders if orders is not None else _table(spark, sf_dir, "orders")
    # orders is keyed by o_orderkey: the join cannot fan out, and no order
    # key is hot (at most a handful of lines per order).
    lines = li.select("l_orderkey", "l_partkey", "l_linenumber")
    dated = od.selectExpr("o_orderkey AS l_orderkey", "o_orderdate")
    seed = "((l_orderkey * 31 + l_linenumber * 17) % 1401)"
    return lines.join(dated, "l_orderkey").selectExpr(
        f"{_pid('l_partkey')} AS product_id",
        "o_orderdate AS review_ts",
        f"cast(1 + {seed} div 281 as int) AS rating",
        f"cast(cast({seed} - 600 as decimal(5,0)) * cast(0.001 as decimal(4,3)) as decimal(7,3)) AS sentiment_score",
    )


def inventory(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    li = lineitem if lineitem is not None else _table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        f"{_pid('l_partkey')} AS product_id",
        "cast(l_shipdate as date) AS snapshot_date",
        "cast((l_suppkey * 97 + l_orderkey) % 500 as int) AS stock_on_hand",
        "cast(cast((l_orderkey * 13 + l_linenumber) % 3600 as decimal(5,0)) * cast(0.01 as decimal(3,2))"
        " as decimal(7,2)) AS stockout_hours",
        "cast(cast((l_orderkey * 29 + l_suppkey) % 890 + 80 as decimal(5,0)) * cast(0.001 as decimal(4,3))"
        " as decimal(7,3)) AS sell_through_pct",
    )


def datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``{"products", "orders", "reviews", "inventory"}`` from the parquet tables.

    Each table is resolved once; every dataset still gets its own scan with
    its own pruned columns.
    """
    lineitem = _table(spark, sf_dir, "lineitem")
    return {
        "products": products(spark, sf_dir),
        "orders": sales(spark, sf_dir, lineitem),
        "reviews": reviews(spark, sf_dir, lineitem),
        "inventory": inventory(spark, sf_dir, lineitem),
    }
