"""Golden rows for the serving views and chart series."""

import datetime as dt
import math

from portolan.functions.columns import log_scale
from portolan.operators import series as ser
from portolan.operators import views as vw

YEARLY = ("year int, partnerISO string, commodity_desc string, hs_code string, "
          "annual_value_usd double, quantity double, unit_value_usd double, share_of_year_market double")


def test_partner_share_view_drops_world_and_null_partner(spark):
    df = spark.createDataFrame([
        (2020, "DEU", "A; x", "01", 100.0, 1.0, 100.0, 0.25),
        (2020, "DEU", "B", "02", 50.0, 1.0, 50.0, 0.75),
        (2020, "W00", "A; x", "01", 400.0, 1.0, 400.0, 1.0),
        (2020, None, "A; x", "01", 1.0, 1.0, 1.0, 0.1),
    ], YEARLY)
    rows = vw.partner_share_view(df).collect()
    assert [(r.partnerISO, r.year, r.partner_value_usd, r.avg_market_share) for r in rows] == [
        ("DEU", 2020, 150.0, 0.5)]


def test_commodity_ranking_short_name_and_order(spark):
    df = spark.createDataFrame([
        (2020, "DEU", "Live animals; horses", "01", 10.0, 2.0, 5.0, 1.0),
        (2021, "POL", "Live animals; cattle", "01", 30.0, 3.0, 10.0, 1.0),
        (2020, "DEU", "Fish", "03", 5.0, 0.0, 0.0, 1.0),
    ], YEARLY)
    rows = vw.commodity_ranking_view(df).collect()
    assert [(r.commodity_short, r.hs_code, r.total_value_usd, r.avg_unit_price) for r in rows] == [
        ("Live animals", "01", 40.0, 7.5), ("Fish", "03", 5.0, 0.0)]


def test_trade_time_view_weighted_vs_row_mean(spark):
    df = spark.createDataFrame([(2020, 1, 100.0, 10.0, 10.0), (2020, 1, 10.0, 0.0, 0.0)],
                               "year int, month int, primary_value_usd double, quantity double, "
                               "unit_value_usd double")
    plain = vw.trade_time_view(df).first()
    weighted = vw.trade_time_view(df, weighted=True).first()
    assert (plain.total_value_usd, plain.total_quantity, plain.avg_unit_price) == (110.0, 10.0, 5.0)
    assert weighted.avg_unit_price == 11.0


def test_dense_grid_fills_absent_cells(spark):
    vals = spark.createDataFrame([("A", dt.date(2020, 1, 1), 5.0), ("B", dt.date(2020, 2, 1), 7.0)],
                                 "commodity string, date date, value double")
    grid = {(r.commodity, r.date): r.value for r in ser.dense_grid(vals, "commodity", "date", "value").collect()}
    assert grid == {("A", dt.date(2020, 1, 1)): 5.0, ("A", dt.date(2020, 2, 1)): 0.0,
                    ("B", dt.date(2020, 1, 1)): 0.0, ("B", dt.date(2020, 2, 1)): 7.0}


def test_top_partner_ties_and_ticks(spark):
    totals = spark.createDataFrame([("AAA", 999.0), ("ZZZ", 999.0), ("MMM", 9.0)],
                                   "partnerISO string, export double")
    top = ser.top_partner(totals).first()
    assert (top.top_partner, top.top_export) == ("ZZZ", 999.0)
    logs = totals.withColumn("log_export", log_scale("export"))
    ticks = ser.axis_ticks(logs, 6).orderBy("i").collect()
    assert len(ticks) == 6
    assert math.isclose(ticks[0].tick, 1.0) and math.isclose(ticks[-1].tick, 3.0)
    assert ticks[0].label == "$9" and ticks[-1].label in ("$999", "$998")


def test_partner_totals_world_excluded_and_log(spark):
    df = spark.createDataFrame([(1998, "W00", 5.0), (1998, "DEU", 9.0), (1997, "DEU", 1.0)],
                               "year int, partnerISO string, primary_value_usd double")
    rows = ser.partner_totals(df, 1998).collect()
    assert [(r.partnerISO, r.export, r.log_export) for r in rows] == [("DEU", 9.0, 1.0)]


def test_dense_grid_of_nothing_is_empty_and_typed(spark):
    vals = spark.createDataFrame([], "commodity string, date date, value double")
    grid = ser.dense_grid(vals, "commodity", "date", "value")
    assert grid.count() == 0 and dict(grid.dtypes) == {"commodity": "string", "date": "date", "value": "double"}


def test_dense_grid_of_a_long_axis_and_a_repeated_cell(spark, tmp_path):
    n, path = 10_001, str(tmp_path / "cells")
    cells = spark.range(n).selectExpr("if(id % 2 = 0, 'even', null) as s", "cast(id as int) as x", "cast(id as double) as v")
    again = spark.createDataFrame([("even", 4, 1.5), ("even", 6, None), ("even", None, 9.0)], "s string, x int, v double")
    cells.union(again).write.parquet(path)
    table = spark.read.parquet(path)
    out = ser.dense_grid(table, "s", "x", "v", fill=-1.0)
    got = {(r.s, r.x): r.v for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(got) == 2 * n
    assert (got["even", 4], got["even", 6], got["even", 5]) == (5.5, 6.0, -1.0)
    assert (got[None, 5], got[None, 4]) == (5.0, -1.0)
    assert sum(v for v in got.values() if v >= 0) == n * (n - 1) / 2 + 1.5
    assert plan.count("FileScan parquet") == 1  # every part starts from one exchange
    few = ser.dense_grid(table, "s", "x", "v", fill=-1.0, slice_points=7)
    assert few.filter("v >= 0").count() == n


def test_axis_points_are_ordered(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "x string")
    assert [r.x for r in ser.axis_points(df, "x").collect()] == ["a", "b"]


def test_views_leave_the_sort_out_on_request(spark):
    df = spark.createDataFrame([(2020, "DEU", "A; x", "01", 10.0, 2.0, 5.0, 1.0)], YEARLY)
    for view in (vw.commodity_ranking_view, vw.partner_share_view):
        assert "Sort" in view(df)._jdf.queryExecution().optimizedPlan().toString()
        assert "Sort" not in view(df, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
