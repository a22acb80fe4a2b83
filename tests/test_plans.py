"""The registered queries against SQL, and the shape of their plans."""

from __future__ import annotations

import os
import re
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import tabscope as ts
from check_oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(df):
    """Pushed filters and columns of the scan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.search(r"PushedFilters: \[(.*)\]", text)[1], re.search(r"ReadSchema: struct<(.*)>", text)[1]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_entry_without_the_text_operators(tmp_path, also):
    """The rest imports where the subpackage for texts is deleted, with or without the pipeline that needs it."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    gone = shutil.ignore_patterns(".git", "__pycache__", "llm", *also)
    shutil.copytree(root, tmp_path / "copy", ignore=gone)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.LLM_QUERIES))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=300)
    assert said.stdout.split() == [str(len(entry.QUERIES)), str(len(entry.ORACLE)), "False"], said.stderr


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows == sorted(rows)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_against_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR) is None


def test_filters_reach_the_scan(orders):
    filters, columns = scan_of(ts.time_analysis(orders, "o_orderdate", "o_totalprice", year=1997))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in filters
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in filters
    assert {c.split(":")[0] for c in columns.split(",")} == {"o_totalprice", "o_orderdate"}
    for column, values in (("o_custkey", ["7", 9]), ("o_orderpriority", ["1-URGENT", "2-HIGH"])):
        filters, _ = scan_of(ts.groupby_analysis(orders, column, "o_totalprice", filter_values=values))
        assert f"In({column}, [" in filters


def test_top_n_needs_no_full_sort(orders):
    plan = plan_of(ts.groupby_analysis(orders, "o_custkey", "o_totalprice", "sum", top_n=5))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_windows_run_after_aggregation(orders):
    plan = plan_of(ts.percentage_change(orders, "o_orderdate", "o_totalprice", max_changes=None))
    assert plan.index("Window") < plan.index("HashAggregate") < plan.index("FileScan")


def test_distinct_counts_do_not_expand(orders):
    assert "Expand" not in plan_of(ts.dataset_info(orders))


def test_median_keeps_no_group_in_one_buffer(orders):
    plan = plan_of(ts.groupby_analysis(orders, "o_orderpriority", "o_totalprice", "median"))
    assert "percentile" not in plan
    assert "partial_count" in plan


def test_no_cartesian_products(spark):
    names = ("statistics_all", "outliers_all", "chart_box", "chart_histogram", "profile", "relationships", "join_viability")
    for name in names:
        plan = plan_of(entry.queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_join_check_is_one_shuffle(spark, orders):
    customer = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    plan = plan_of(ts.inspect_join_viability(customer, orders, "c_custkey", "o_custkey"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
