"""Registered queries against their SQL on the smallest tables.

All of them; set WHARFLINE_SELECTION=1 for a quick look at some. Queries of the
training-data operators are compared next to their own tests.
"""

import glob
import os
import sys

import pytest

duckdb = pytest.importorskip("duckdb")

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import comparable  # noqa: E402

from wharfline.functions.durable import scope  # noqa: E402
from wharfline.plans import registered  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SELECTION = [
    "monthly_region_lead_times", "clean_orders", "lead_time_scores", "product_order_statistics", "business_kpis",
    "stock_heatmap", "monthly_costs", "lead_time_density", "demand_decomposition", "order_line_lags",
    "demand_autocorrelation", "demand_model_comparison", "abc_analysis", "demand_sensitivity", "row_check_orders",
    "expectation_results", "data_dictionary", "supply_path_metrics", "whole_lane_clustering", "split_orders", "streamed_orders",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(SELECTION) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "lead_time_mean" in df.columns


@pytest.mark.parametrize("name", SELECTION if os.environ.get("WHARFLINE_SELECTION") else sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    result = tables.execute(registered.oracle_sql()[name])
    expected = comparable([d[0] for d in result.description], result.fetchall())
    with scope(spark):
        df = registered.queries()[name](spark, FOLDER)
        assert comparable(df.columns, [tuple(r) for r in df.collect()]) == expected
