"""Physical-plan properties: no Python evaluation, broadcast dimensions,
bounded exchanges, filters in the scans."""

import pytest

import __spark_entry__ as E
from portolan.plans import marts
from portolan.plans.catalog import QUERIES
from portolan.plans.context import Domain
from portolan.plans.params import QUERY_YEARS
from tests.conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.endswith("_stream")])
def test_no_python_udf_in_plan(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_dimension_lookups_are_broadcast(spark):
    plan = _plan(marts.monthly_mart(Domain(spark, SMALL)))
    assert plan.count("BroadcastHashJoin") >= 2  # partner code, currency


def test_yearly_rollup_exchanges(spark):
    """Partial + final aggregate on the 4 keys, then one window exchange on
    (year, hs_code) over the rolled-up rows -- the input is read once."""
    import re
    df = marts.trade_yearly(Domain(spark, SMALL))
    plan = _plan(df)
    assert plan.count("partial_sum") >= 1
    keys = re.findall(r"Exchange hashpartitioning\(([a-zA-Z_]+)", plan)
    # rollup keys and window keys, beside the uniqueness check of the code table
    assert [k for k in keys if k != "__lk"] == ["year", "year"] and keys.count("__lk") == 1
    assert plan.count("FileScan parquet") == 5  # lineitem, orders, customer, part, nation


def test_year_filter_reaches_fx_scan_side(spark):
    d = Domain(spark, SMALL)
    plan = _plan(marts.monthly_mart(d, QUERY_YEARS))
    assert "Filter" in plan and "1996" in plan and "2000" in plan


def test_scan_prunes_columns(spark):
    df = E.queries()["view_trade_time"](spark, SMALL)
    plan = _plan(df)
    assert "l_discount" not in plan and "l_tax" not in plan and "o_totalprice" not in plan


def test_pivot_with_value_list_runs_no_job_at_definition(spark):
    from portolan.operators.indicators import pivot_indicators
    df = spark.createDataFrame([("A", 1, "b", 2.0)], "c string, y int, indicator_name string, value double")
    sc = spark.sparkContext
    sc.setJobGroup("pivot-definition", "pivot definition only")
    try:
        pivot_indicators(df, ["b", "z"], keys=["c", "y"])
        assert list(sc.statusTracker().getJobIdsForGroup("pivot-definition")) == []
        df.groupBy("c", "y").pivot("indicator_name").agg({"value": "max"})  # no list: discovery job
        assert list(sc.statusTracker().getJobIdsForGroup("pivot-definition")) != []
    finally:
        sc.setJobGroup(None, None)
