"""Typed readers: explicit schema, bad text -> null, glob of indicator
files, mart reader pruning partitions."""

import tempfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from portolan.sources import lake
from portolan.sources import tables as src
from portolan.sources.lake import LakePaths, materialize_counted, write_table


def test_read_trade_casts_and_drops_extra_columns(spark):
    folder = tempfile.mkdtemp(prefix="trade-")
    spark.createDataFrame(
        [("202001", "01", "A; x", "276", "10", "abc", "1.5", "extra")],
        "data_period string, hs_code string, commodity_desc string, partner_code string, "
        "quantity string, weight string, primary_value_usd string, junk string",
    ).write.mode("overwrite").parquet(folder)
    df = src.read_trade(spark, folder)
    assert df.columns == ["data_period", "hs_code", "commodity_desc", "partner_code",
                          "quantity", "weight", "primary_value_usd"]
    row = df.first()
    assert (row.quantity, row.weight, row.primary_value_usd) == (10.0, None, 1.5)


def test_read_trade_missing_column_fails_loudly(spark):
    folder = tempfile.mkdtemp(prefix="trade-")
    spark.createDataFrame([("202001",)], "data_period string").write.mode("overwrite").parquet(folder)
    with pytest.raises(ValueError):
        src.read_trade(spark, folder)


def test_read_indicators_glob(spark):
    folder = tempfile.mkdtemp(prefix="wdi-")
    for i, (year, value) in enumerate([("2019", "1.5"), ("2020", "n/a")]):
        spark.createDataFrame([("PL", "Poland", year, "GDP (current US$)", value)],
                              "country_id string, country_name string, year string, "
                              "indicator_name string, value string"
                              ).write.mode("overwrite").parquet(f"{folder}/part{i}.parquet")
    df = src.read_indicators(spark, f"{folder}/*.parquet")
    got = sorted((r.year, r.value) for r in df.collect())
    assert got == [(2019, 1.5), (2020, None)]


def test_read_fx_keeps_text_date(spark):
    folder = tempfile.mkdtemp(prefix="fx-")
    spark.createDataFrame([("EUR", "2020-01-02", "4.25")], "currency string, date string, rate string"
                          ).write.mode("overwrite").parquet(folder)
    row = src.read_fx(spark, folder).first()
    assert (row.date, row.rate) == ("2020-01-02", 4.25)


def test_read_mart_prunes_years(spark):
    lake = LakePaths(tempfile.mkdtemp(prefix="lake-"))
    df = spark.range(20).select((F.col("id") % 5 + 1996).cast("int").alias("year"), "id")
    write_table(df, lake.table("m"), ["year"])
    m = src.read_mart(spark, lake.table("m"), years=(1997, 1998))
    assert m.count() == 8
    assert "PartitionFilters: [isnotnull(year" in m._jdf.queryExecution().executedPlan().toString()


def test_materialize_counted_observes_rows(spark):
    t, n = materialize_counted(spark.range(123), "probe")
    assert n == 123 and t.count() == 123


def test_partitioned_write_sorts_no_rows(spark, tmp_path, monkeypatch):
    """Also of more partitions than a task keeps files open for; the session's
    own setting stays."""
    import pyarrow.parquet as pq
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "sortWithinPartitions", lambda *a, **k: pytest.fail("the table is sorted"))
    seen, parquet = [], DataFrameWriter.parquet

    def watched(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(lake._OPEN_FILES)))
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    before = spark.conf.get(lake._OPEN_FILES)
    rows = spark.range(4000, numPartitions=2).select("id", (F.col("id") % (2 * lake.OPEN_FILES)).cast("int").alias("year"))
    write_table(rows, str(tmp_path / "t"), ["year"])
    assert seen == [lake.OPEN_FILES] and spark.conf.get(lake._OPEN_FILES) == before
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert len({f.parent for f in files}) == 2 * lake.OPEN_FILES
    assert pq.ParquetFile(files[0]).metadata.row_group(0).column(0).compression == "ZSTD"
    assert spark.read.parquet(str(tmp_path / "t")).exceptAll(rows).isEmpty()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000


def test_materialize_empty_partitioned_table(spark):
    empty = spark.range(0).select(F.col("id").cast("int").alias("year"), F.lit("x").alias("v"))
    t, n = materialize_counted(empty, "empty", ["year"])
    assert n == 0 and t.count() == 0 and sorted(t.columns) == ["v", "year"]


def test_membership_filter_and_pruning_reach_the_scan(spark):
    from portolan.operators.filters import members
    folder = tempfile.mkdtemp(prefix="scan-")
    spark.range(100).select(F.col("id").cast("string").alias("c"), F.col("id").alias("v"),
                            F.lit("wide").alias("unused")).write.mode("overwrite").parquet(folder)
    df = members(spark.read.parquet(folder), "c", ["1", "2"]).select("c", "v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c), In(c, [1,2])]" in plan or "In(c" in plan
    assert "ReadSchema: struct<c:string,v:bigint>" in plan
    assert df.count() == 2


def test_dimension_write_round_trip(spark):
    from portolan.sources.dimensions import currency_dimension, write_dimension
    path = tempfile.mkdtemp(prefix="dim-") + "/currency"
    write_dimension(currency_dimension(spark), path)
    back = spark.read.parquet(path)
    assert back.count() == 182 and back.rdd.getNumPartitions() == 1
