"""Joins cannot multiply rows; plans start no job; ranges reach the files;
nothing outside a list vanishes."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as E
from portolan.functions.columns import exact_digits
from portolan.operators import fx, indicators as ind, quality as dq
from portolan.operators import joins
from portolan.operators.filters import period_range, year_range
from portolan.plans import marts
from portolan.plans.catalog import QUERIES
from portolan.plans.context import Domain, FileDomain
from tests.conftest import SMALL


def _jobs(spark, build):
    sc = spark.sparkContext
    sc.setJobGroup("definition", "definition only")
    try:
        build()
        return list(sc.statusTracker().getJobIdsForGroup("definition"))
    finally:
        sc.setJobGroup(None, None)


class _Spellings(Domain):
    """One country's indicators of a year under two names."""

    @property
    def wdi_raw(self):
        raw = Domain.wdi_raw.fget(self)
        twin = raw.filter("country_id = 'BX' and year = '1998'").withColumn("country_name", F.lit("Nation One"))
        return raw.unionByName(twin)


def test_a_country_under_two_names_raises_and_is_reported(spark):
    d = _Spellings(spark, SMALL)
    with pytest.raises(PySparkException, match="indicators by country and year: key is not unique: N01, 1998"):
        marts.yearly_mart(d, (1996, 2000)).collect()
    assert [tuple(r) for r in marts.indicator_repeats(d).collect()] == [("N01", 1998, 2)]
    assert marts.indicator_repeats(Domain(spark, SMALL)).count() == 0
    # the account shows the rows that such a join would add
    y = marts.trade_yearly(d)
    got = {r.stage: r.row_count for r in joins.join_accounting(y, "rows", [
        joins.Step("joined", marts.indicators(d), ("partnerISO", "year"), ("countryISO3", "year"))]).collect()}
    assert got["joined"] == got["rows"] + y.filter("partnerISO = 'N01' and year = 1998").count()


def test_unique_side_keeps_rows_and_drops_null_keys(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5), (None, "x", 1), (None, "y", 1)], "k int, v string, w int")
    out = joins.unique_side(df, ["k"], "side")
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(1, "a", None), (2, None, 5)]
    assert [tuple(r) for r in joins.repeated_keys(df.union(df), ["k", "w"]).collect()] == [(2, 5, 2)]


def test_accounting_equals_counts_of_the_joins(spark):
    rows = spark.createDataFrame([(i % 5 if i % 7 else None, i % 3) for i in range(60)], "a int, b int")
    one = spark.createDataFrame([(0,), (1,), (1,), (None,)], "x int")
    two = spark.createDataFrame([(0, 1), (2, 2), (2, 2)], "x int, y int")
    steps = [joins.Step("one", one, ("a",), ("x",)), joins.Step("two", two, ("a", "b"), ("x", "y"), F.col("b") > 0)]
    got = {r.stage: r.row_count for r in joins.join_accounting(rows, "rows", steps).collect()}
    first = rows.join(one, F.col("a") == F.col("x"), "left").drop("x")
    second = first.join(two, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left")
    assert got == {"rows": 60, "one": first.count(), "two": second.filter("b > 0").count()}


def test_row_guard_raises_after_the_one_run(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    for right, fails in ((spark.createDataFrame([(1, "a")], "k int, v string"), False),
                         (spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), True)):
        guard = joins.RowGuard("probe")
        guard.after(guard.before(left).join(right, "k", "left")).write.format("noop").mode("overwrite").save()
        if fails:
            with pytest.raises(joins.FanOutError, match="2 rows before the joins, 3 behind"):
                guard.check()
        else:
            assert guard.check() == 2


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if "stream" not in n and "serving_rates" not in n
                                  and not n.startswith(("rates_", "lake_", "published_"))])
def test_batch_queries_start_no_job_while_built(spark, name):
    d = Domain(spark, SMALL)
    for table in ("lineitem", "orders", "customer", "part", "nation"):
        getattr(d.tables, table)  # a parquet file's schema is read by a job of its own
    with exact_digits(money=2, rates=8):
        assert _jobs(spark, lambda: QUERIES[name].plan(d)) == []


def test_years_reach_the_trade_files(spark, tmp_path):
    trade = spark.createDataFrame([("200401", "01", "a", "1", 1.0, 1.0, 1.0), ("2003", "01", "a", "1", 1.0, 1.0, 1.0),
                                   ("2023", "01", "a", "1", 1.0, 1.0, 1.0), ("2024", "01", "a", "1", 1.0, 1.0, 1.0),
                                   (None, "01", "a", "1", 1.0, 1.0, 1.0), ("abc", "01", "a", "1", 1.0, 1.0, 1.0)],
                                  "data_period string, hs_code string, commodity_desc string, partner_code string, "
                                  "quantity double, weight double, primary_value_usd double")
    trade.write.parquet(str(tmp_path / "trade"))
    spark.createDataFrame([(1, "AA", "AAA")], "iso_numeric int, iso2 string, iso3 string").write.parquet(str(tmp_path / "codes"))
    d = FileDomain(spark, str(tmp_path / "trade"), "", "", str(tmp_path / "codes"))
    rows = marts.monthly_features(d, (2004, 2023))
    assert sorted(r.data_period for r in rows.collect()) == ["2004" + "01", "2023"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_period,2004)" in plan and "LessThan(data_period,2024)" in plan
    assert period_range(trade, 5, 10).count() == 6  # no four digits: the year filter decides alone
    assert year_range(trade.withColumn("year", F.lit(2004)), 2004, 2004).count() == 6


def test_pivot_keeps_what_is_not_listed(spark):
    df = spark.createDataFrame([("A", 1, "a", 1.0), ("A", 1, "a", 3.0), ("A", 1, "z", 2.0), ("A", 1, "z", 1.0),
                                ("A", 1, None, 7.0), ("B", 1, "b", None)],
                               "c string, year int, indicator_name string, value double")
    rows = {r.c: r.asDict() for r in ind.pivot_with_rest(df, ["a", "b"], keys=["c", "year"]).collect()}
    assert rows["A"] == {"c": "A", "year": 1, "a": 3.0, "b": None, "other_indicators": {"z": 2.0, "": 7.0}}
    assert rows["B"]["other_indicators"] == {} and rows["B"]["b"] is None
    unknown = {r.indicator_name: r.n_rows for r in ind.unknown_indicators(df, ["a", "b"]).collect()}
    assert unknown == {"z": 2, None: 1}
    report = ind.rename_report(df, {"value": "v", "gone": "g"}).collect()
    assert [tuple(r) for r in report] == [("value", "v", True), ("gone", "g", False)]


def test_profile_is_the_same_however_the_rows_lie(spark):
    df = spark.createDataFrame([(i, f"t{i % 40}" if i % 3 else " ", i / 7 if i % 2 else float("nan")) for i in range(300)],
                               "a int, b string, c double")
    first = sorted(map(tuple, dq.profile(df, "t").collect()))
    assert first == sorted(map(tuple, dq.profile(df.repartition(7), "t").collect()))
    value = {(s, i): v for _, s, i, v in first}
    assert value["rows", "all"] == "300" and value["schema", "c"] == "double"
    assert value["null_share", "b"] == "0.333333" and value["null_share", "c"] == "0.500000"
    assert len([k for k in value if k[0] == "sample"]) == 5
    empty = {(s, i): v for _, s, i, v in map(tuple, dq.profile(df.limit(0), "t").collect())}
    assert empty["rows", "all"] == "0" and empty["null_share", "a"] is None


def test_means_outside_their_bounds_are_found(spark):
    df = spark.createDataFrame([("E", 1.0, 2.0, 1.5), ("F", 1.0, 2.0, 2.1), ("G", 1.0, 2.0, 0.5)],
                               "currency string, min_rate double, max_rate double, avg_rate double")
    assert sorted(r.currency for r in fx.bounds_violations(df).collect()) == ["F", "G"]
    dates = spark.createDataFrame([("2024-02-30",), ("2024-02-28",), (None,), ("x",)], "date string")
    assert sorted(str(r.date) for r in fx.unparsable_dates(dates).collect()) == ["2024-02-30", "None", "x"]


def test_entry_names_every_query_once():
    assert set(QUERIES) <= set(E.queries())
