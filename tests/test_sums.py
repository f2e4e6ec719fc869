"""Sums and means are plain by default and never leave values out."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from portolan.functions.columns import exact_digits, fixed_mean, fixed_sum
from portolan.operators.joins import lookup
from portolan.operators.quality import numeric_stats
from portolan.plans.context import MART_YEARS
from portolan.streaming.jobs import file_stream


def _doubles(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_small_values_are_not_rounded_away(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert df.agg(fixed_sum("v")).first()[0] == pytest.approx(4.0)


def test_large_infinite_and_nan_values_count(spark):
    assert _doubles(spark, 1e17, 5.0).agg(fixed_sum("v")).first()[0] == 1e17 + 5.0
    assert math.isinf(_doubles(spark, 1e17, math.inf).agg(fixed_sum("v")).first()[0])
    assert math.isnan(_doubles(spark, math.nan, 5.0).agg(fixed_sum("v")).first()[0])
    assert _doubles(spark, 1.0, 2.0005).agg(fixed_mean("v")).first()[0] == pytest.approx(1.50025)


def test_exact_mode_raises_on_more_digits(spark):
    with exact_digits(money=2):
        good, bad = fixed_sum("v"), fixed_sum("v")
    assert _doubles(spark, 0.1, 0.2).agg(good).first()[0] == 0.3
    for value in (0.004, math.nan, math.inf, 1e17):
        with pytest.raises(PySparkException):
            _doubles(spark, value).agg(bad).first()


def test_exact_mean_of_a_total_beyond_a_long(spark):
    """2e11 at 8 digits is 2e19 units, more than 64 bits hold."""
    df = spark.range(4).select((F.lit(5e10) + F.col("id")).alias("v"))
    with exact_digits():
        mean, stats = fixed_mean("v"), numeric_stats(df, ["v"])
    assert df.agg(mean).first()[0] == pytest.approx(5e10 + 1.5, rel=1e-15)
    assert stats.first()["mean"] == pytest.approx(5e10 + 1.5, rel=1e-15)
    assert numeric_stats(df, ["v"], scale=2).first()["mean"] == 5e10 + 1.5


def test_duplicate_keys_raise_beyond_the_broadcast_bound(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    out = lookup(left, dim, "k", "k", ["v"], max_bytes=0)
    with pytest.raises(PySparkException, match="not unique: 1"):
        out.collect()


def test_library_years():
    assert MART_YEARS == (2004, 2023)


def test_stream_of_a_directory_table(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    stream = file_stream(spark, str(tmp_path), "events")
    query = (stream.writeStream.format("memory").queryName("dir_events").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.awaitTermination()
    assert spark.table("dir_events").count() == 100
    with pytest.raises(PySparkException):
        file_stream(spark, str(tmp_path), "absent")
