"""Property tests over generated inputs (kept to a few examples: each is a
Spark job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portolan.operators import fx as fxo
from portolan.operators import series as ser
from portolan.operators.joins import lookup
from portolan.operators.rollup import rollup_sums
from portolan.operators.shares import share_of_total

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["a", "b", "c", None])
cents = st.integers(min_value=0, max_value=10_000_00).map(lambda c: c / 100)
rows = st.lists(st.tuples(keys, st.sampled_from([1, 2]), cents), min_size=1, max_size=40)


@SETTINGS
@given(rows)
def test_shares_sum_to_one(spark, data):
    df = spark.createDataFrame(data, "k string, p int, v double")
    out = share_of_total(df, "v", ["k", "p"], "t", "s")
    for r in out.groupBy("k", "p").agg(F.sum("s").alias("ss"), F.max("t").alias("t")).collect():
        if r.t and r.t > 0:
            assert abs(r.ss - 1.0) < 1e-9


@SETTINGS
@given(rows)
def test_rollup_total_equals_base_total(spark, data):
    df = spark.createDataFrame(data, "k string, p int, v double")
    base = round(sum(v for _, _, v in data), 2)
    rolled = rollup_sums(df, ["k", "p"], {"v": "v"}).agg(F.sum("v").alias("v")).first().v
    assert abs(rolled - base) < 1e-6


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["E", "U"]),
                          st.dates().map(lambda d: d.isoformat()),
                          st.floats(min_value=0.01, max_value=100, allow_nan=False)),
                min_size=1, max_size=30))
def test_min_le_avg_le_max(spark, data):
    df = spark.createDataFrame(data, "currency string, date string, rate double")
    assert fxo.bounds_violations(fxo.fx_monthly(df), tol=1e-7).count() == 0


@SETTINGS
@given(st.lists(keys, min_size=1, max_size=30))
def test_left_lookup_keeps_row_count(spark, ks):
    df = spark.createDataFrame([(k,) for k in ks], "k string")
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert lookup(df, dim, F.col("k"), "k", ["v"]).count() == len(ks)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(0, 5), cents),
                min_size=1, max_size=30))
def test_dense_grid_size(spark, data):
    df = spark.createDataFrame(data, "s string, a int, v double")
    vals = df.groupBy("s", "a").agg(F.sum("v").alias("v"))
    grid = ser.dense_grid(vals, "s", "a", "v")
    n_s = len({s for s, _, _ in data})
    n_a = len({a for _, a, _ in data})
    assert grid.count() == n_s * n_a
    present = {(s, a) for s, a, _ in data}
    for r in grid.collect():
        if (r.s, r.a) not in present:
            assert r.v == 0.0


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["01", "02", "", None]),
                          st.sampled_from(["Live animals", " Live animals ", "Fish; x", "", None,
                                           "A very long commodity name beyond twenty"])),
                min_size=1, max_size=20))
def test_row_keys_unique_or_reported(spark, data):
    from collections import Counter

    from portolan.operators import serving as srv
    from portolan.operators.joins import key_collisions
    df = spark.createDataFrame(data, "hs_code string, commodity_short string")
    keys = df.select(srv.commodity_key().alias("row_key"))
    counts = Counter(r.row_key for r in keys.collect())
    reported = {r.row_key: r.n for r in key_collisions(keys, "row_key").collect()}
    assert reported == {k: n for k, n in counts.items() if n > 1}
