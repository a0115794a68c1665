"""The same queries where one key holds a third of all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from compare import connect, difference

import __spark_entry__ as driver

SF = Path("/root/testdata/sf0.001")
HOT = {
    "lineitem": "CASE WHEN i % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN i % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey, "
                "CASE WHEN i % 3 = 2 THEN 5 ELSE l_suppkey END AS l_suppkey",
    "orders": "CASE WHEN i % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey, "
              "CASE WHEN i % 3 = 1 THEN TIMESTAMP '1997-03-03' ELSE o_orderdate END AS o_orderdate",
    "events": "CASE WHEN i % 3 = 0 THEN 3 ELSE user_id END AS user_id",
}
QUERIES = (
    "silver_clientes", "silver_drivers", "silver_orders", "silver_order_items", "ref_integrity",
    "gold_daily_delivery_kpis", "gold_restaurant_performance", "gold_item_category_metrics",
    "cost_summary_daily", "cost_top_resources", "cost_rolling_7d", "layout_clustered",
    "stream_equals_batch",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        rows = f"SELECT * FROM '{file}'"
        if file.stem in HOT:
            rows = (f"SELECT * EXCLUDE (i) REPLACE ({HOT[file.stem]}) "
                    f"FROM (SELECT *, row_number() OVER () AS i FROM '{file}')")
        con.execute(f"COPY ({rows}) TO '{folder}/{file.name}' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys_change_nothing(spark, skewed, name):
    assert difference(driver.queries()[name](spark, skewed), connect(skewed), driver.oracle_sql()[name]) is None
