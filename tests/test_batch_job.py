"""The batch job writes every table; read-backs equal the lazy queries and
year filters prune partitions."""

import tempfile

import pytest
from pyspark.errors import PySparkException

import __spark_entry__ as E
from portolan.functions.columns import exact_digits
from portolan.plans.batch_job import build_all
from portolan.plans.context import Domain
from portolan.plans.params import QUERY_YEARS
from portolan.sources.dimensions import currency_dimension
from portolan.sources.lake import LakePaths
from tests.conftest import SMALL


def test_build_all_round_trip(spark):
    lake = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    counts = {}
    with exact_digits():  # as the registered queries
        out = build_all(Domain(spark, SMALL), lake, QUERY_YEARS, row_counts=counts)
    assert counts["monthly_features"] == E.queries()["trade_features"](spark, SMALL).count()
    assert counts["yearly_currency"] == counts["trade_yearly"]  # left lookup keeps rows
    assert {"monthly", "yearly", "yearly_currency", "serving/trade_time"} <= set(out)
    monthly = spark.read.parquet(out["monthly"])
    assert monthly.count() == counts["monthly"] == E.queries()["monthly_mart"](spark, SMALL).count()
    yearly = spark.read.parquet(out["yearly"])
    lazy = E.queries()["yearly_mart"](spark, SMALL)
    cols = sorted(lazy.columns)
    assert sorted(yearly.columns) == cols
    assert sorted(map(tuple, yearly.select(cols).collect())) == sorted(map(tuple, lazy.select(cols).collect()))
    pruned = spark.read.parquet(out["monthly"]).filter("year = 1997")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    serving = spark.read.parquet(out["serving/trade_time"])
    assert serving.filter("size(cells) = 0").count() == 0



def test_packaged_currency_dimension(spark):
    dim = currency_dimension(spark)
    assert dim.count() == 182
    assert dim.select("country_iso3").distinct().count() == 182
    assert dim.filter("currency is null").count() == 13
    assert dim.filter("country_iso3 = 'DEU'").first().currency == "EUR"


def test_a_dimension_with_a_repeated_key_stops_the_job(spark):
    class Twice(Domain):
        @property
        def currency_dim(self):
            dim = Domain.currency_dim.fget(self)
            return dim.unionByName(dim.filter("country_iso3 = 'N03'"))
    with pytest.raises(PySparkException, match="lookup by country_iso3: key is not unique: N03"), exact_digits():
        build_all(Twice(spark, SMALL), LakePaths(tempfile.mkdtemp(prefix="lake-")), QUERY_YEARS)
