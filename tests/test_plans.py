"""Plan regression guards: the properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from flowstat.plans import catalog

from .conftest import SF0001

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pairwise_joins_or_row_udfs(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    assert not [b for b in BAD if b in plan], name


def test_pushdown_pruning_and_partial_topn(spark):
    df = E.queries()["hot_items_topn"](spark, SF0001)
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in scan
    # only the three needed columns are read
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in scan


def test_interval_join_is_keyed_by_time_bucket(spark):
    plan = _plan(E.queries()["tx_match_interval"](spark, SF0001))
    assert "_b#" in plan and ("HashJoin" in plan or "SortMergeJoin" in plan)


@pytest.mark.parametrize("name, scans, joins, exchanges", [
    ("tx_match_full", 2, 1, 3), ("login_fail_consecutive", 1, 0, 1), ("login_fail_sequence", 1, 0, 1),
    ("order_pay_paid", 1, 0, 1), ("ad_clicks_filtered", 1, 0, 1), ("order_status", 1, 0, 1),
    # the second scan is the small table of chunks
    ("late_rows", 2, 1, 2), ("hot_pages_with_lateness", 2, 1, 4), ("hot_items_topn_changelog", 1, 0, 3)])
def test_one_pass(spark, name, scans, joins, exchanges):
    """How often the input is read, joined and shuffled where nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()[name](spark, SF0001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("FileScan") == scans
    assert plan.count("SortMergeJoin") + plan.count("HashJoin") == joins
    assert plan.count("Exchange hashpartitioning") <= exchanges
