"""Golden rows (hand-made inputs, expected values worked out by hand)."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions.columns import fixed_sum, guarded_ratio, missing, period_month
from portolan.operators import features as feat
from portolan.operators import fx as fxo
from portolan.operators import indicators as ind
from portolan.operators import quality as dq
from portolan.operators.joins import lookup
from portolan.operators.rollup import yearly_trade
from portolan.operators.shares import share_of_total
from portolan.schemas import TRADE_RAW

S = T.StringType()
RAW_TEXT = T.StructType([T.StructField(f.name, S) for f in TRADE_RAW.fields])
TRADE_ROWS = [
    ("202001", "100", "A; x", "276", "10", "2", "100"),
    ("202001", "100", "A; x", "616", None, "0", "300"),
    ("202002", "100", "A; x", "276", "0", None, "50"),
    ("2020", "200", "B", "0", "1", "1", "7"),
    ("202001", "200", "B", None, "1", "1", None),
]


@pytest.fixture()
def iso(spark):
    return spark.createDataFrame([(276, "DE", "DEU"), (616, "PL", "POL")],
                                 "iso_numeric int, iso2 string, iso3 string")


@pytest.fixture()
def monthly(spark, iso):
    raw = spark.createDataFrame(TRADE_ROWS, RAW_TEXT)
    f = feat.trade_features(raw, iso)
    return share_of_total(f, "primary_value_usd", ["data_period", "hs_code"],
                          "month_world_export_value", "share_of_month_market")


def _by(rows, *keys):
    return {tuple(r[k] for k in keys): r for r in rows}


def test_monthly_features(monthly):
    rows = monthly.collect()
    assert len(rows) == 5
    got = {(r.data_period, r.hs_code, r.partnerISO): r for r in rows}
    deu = got[("202001", "100", "DEU")]
    assert (deu.quantity, deu.weight, deu.unit_value_usd, deu.usd_per_kg) == (10, 2, 10, 50)
    assert (deu.year, deu.month, deu.quarter, deu.quarter_label) == (2020, 1, 1, "Q1")
    assert deu.month_world_export_value == 400 and deu.share_of_month_market == 0.25
    pol = got[("202001", "100", "POL")]
    assert (pol.quantity, pol.weight, pol.unit_value_usd, pol.usd_per_kg) == (0, 0, 0, 0)
    assert pol.share_of_month_market == 0.75
    feb = got[("202002", "100", "DEU")]
    assert feb.month_world_export_value == 50 and feb.share_of_month_market == 1.0
    annual = got[("2020", "200", "UNIDENTIFIED")]
    assert (annual.month, annual.quarter_label, annual.unit_value_usd) == (1, "Q1", 7)
    nul = got[("202001", "200", "UNIDENTIFIED")]
    assert nul.unit_value_usd is None and nul.usd_per_kg is None
    assert nul.month_world_export_value is None and nul.share_of_month_market == 0


def test_window_and_join_strategies_agree(spark, iso):
    raw = spark.createDataFrame(TRADE_ROWS, RAW_TEXT)
    f = feat.trade_features(raw, iso)
    keys = ["data_period", "hs_code"]
    a = share_of_total(f, "primary_value_usd", keys, "t", "s", strategy="join")
    b = share_of_total(f, "primary_value_usd", keys, "t", "s", strategy="window")
    cols = ["data_period", "hs_code", "partnerISO", "t", "s"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_yearly_rollup(spark, iso):
    raw = spark.createDataFrame(TRADE_ROWS, RAW_TEXT)
    y = yearly_trade(feat.trade_features(raw, iso)).collect()
    got = {(r.partnerISO, r.hs_code): r for r in y}
    assert len(got) == 3
    deu = got[("DEU", "100")]
    assert (deu.annual_value_usd, deu.quantity, deu.weight) == (150, 10, 2)
    assert (deu.unit_value_usd, deu.usd_per_kg, deu.world_export_value) == (15, 75, 450)
    assert round(deu.share_of_year_market, 6) == 0.333333
    assert round(got[("POL", "100")].share_of_year_market, 6) == 0.666667
    unk = got[("UNIDENTIFIED", "200")]
    assert (unk.annual_value_usd, unk.quantity, unk.weight, unk.unit_value_usd) == (7, 2, 2, 3.5)
    assert unk.share_of_year_market == 1.0


def test_missing_report_and_fill(spark):
    df = spark.createDataFrame([("a", 1.0), (None, None), (" ", float("nan"))], "k string, v double")
    rep = dq.missing_report(df).first()
    assert (rep.k, rep.v, rep.total_rows) == (2, 2, 3)
    filled = [r.v for r in feat.fill_defaults(df, {"v": 0.0}).collect()]
    assert filled == [1.0, 0.0, 0.0]


def test_missing_predicate_types(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, d decimal(10,2), i int")
    row = df.select([missing(c, df.schema[c].dataType).alias(c) for c in df.columns]).first()
    assert all(row)


def test_guarded_ratio_null_semantics(spark):
    df = spark.createDataFrame([(None, 2.0), (4.0, None), (4.0, 0.0), (4.0, 2.0)], "n double, d double")
    got = [r.x for r in df.select(guarded_ratio("n", "d").alias("x")).collect()]
    assert got == [None, 0.0, 0.0, 2.0]


def test_period_month_rules(spark):
    df = spark.createDataFrame([("202011",), ("2020",), (None,), ("20201",)], "p string")
    assert [r.m for r in df.select(period_month("p").alias("m")).collect()] == [11, 1, 1, 1]


def test_fixed_sum_is_exact(spark):
    vals = [0.1] * 10 + [1e6 + 0.01, -0.03]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(5)
    assert df.agg(fixed_sum("v").alias("s")).first().s == round(1 + 1e6 + 0.01 - 0.03, 2)


def test_fx_join_null_currency_never_matches(spark):
    trade = spark.createDataFrame([("EUR", 2020), (None, 2020)], "currency string, year int")
    rates = spark.createDataFrame([("EUR", 2020, 4.4), (None, 2020, 9.9)],
                                  "currency string, year int, avg_rate double")
    got = {r.currency: r.avg_rate for r in trade.join(rates, ["currency", "year"], "left").collect()}
    assert got == {"EUR": 4.4, None: None}


@pytest.mark.parametrize("agg", ["max", "first"])
def test_pivot_value_list(spark, agg):
    df = spark.createDataFrame(
        [("A", 1, "z", None), ("A", 1, "z", 5.0), ("A", 1, "b", 2.0), ("B", 1, "b", 3.0)],
        "c string, y int, indicator_name string, value double")
    w = ind.pivot_indicators(df, ["b", "z", "missing"], keys=["c", "y"], agg=agg)
    assert w.columns == ["c", "y", "b", "z", "missing"]
    got = {r.c: (r.b, r.z, r.missing) for r in w.collect()}
    assert got == {"A": (2.0, 5.0, None), "B": (3.0, None, None)}


def test_bad_input_becomes_null(spark):
    df = spark.createDataFrame([("abc", "2020-13-45")], "n string, d string")
    row = df.select(F.col("n").try_cast("double").alias("n"),
                    F.try_to_date("d", "yyyy-MM-dd").alias("d"),
                    F.try_divide(F.lit(1), F.lit(0)).alias("z")).first()
    assert (row.n, row.d, row.z) == (None, None, None)
    bad = fxo.unparsable_dates(spark.createDataFrame([("E", "2020-13-45", 1.0), ("E", "2020-01-02", 1.0)],
                                                     "currency string, date string, rate double"))
    assert bad.count() == 1


def test_rate_stats_bounds(spark):
    df = spark.createDataFrame([("E", "2020-01-02", 4.1), ("E", "2020-01-03", 4.3), ("E", "2020-02-01", 4.2)],
                               "currency string, date string, rate double")
    y = fxo.fx_yearly(df).first()
    assert (y.min_rate, y.max_rate) == (4.1, 4.3) and math.isclose(y.avg_rate, 4.2)
    assert fxo.bounds_violations(fxo.fx_monthly(df)).count() == 0


def test_lookup_rejects_duplicate_keys(spark):
    df = spark.createDataFrame([("A",)], "k string")
    dim = spark.createDataFrame([("A", 1), ("A", 2)], "k string, v int")
    with pytest.raises(PySparkException, match="not unique"):
        lookup(df, dim, F.col("k"), "k", ["v"]).collect()


def test_growth_previous_row_and_strict_year(spark):
    df = spark.createDataFrame([("X", 2000, 100.0), ("X", 2001, 110.0), ("X", 2003, 121.0)],
                               "country_id string, year int, gdp double")
    loose = {r.year: r.gdp_growth for r in ind.growth(df, "gdp").collect()}
    assert loose == {2000: None, 2001: 10.0, 2003: 10.0}
    strict = {r.year: r.gdp_growth for r in ind.growth(df, "gdp", strict_year=True).collect()}
    assert strict == {2000: None, 2001: 10.0, 2003: None}


def test_per_capita_half_up(spark):
    df = spark.createDataFrame([(100.01, 2.0), (1.0, 0.0)], "gdp double, population double")
    assert [r.gdp_per_capita for r in ind.per_capita(df).collect()] == [50.01, None]
