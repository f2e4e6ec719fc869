"""Serving rows: key rules, null cells omitted, executor-side writer,
collision report, key-ordered peek."""

import json
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from portolan.operators import serving as srv
from portolan.operators.joins import key_collisions


def test_commodity_key_rules(spark):
    df = spark.createDataFrame(
        [(" Live animals and more text ", "01"), (None, None), ("", "")],
        "commodity_short string, hs_code string")
    keys = [r.k for r in df.select(srv.commodity_key().alias("k")).collect()]
    assert keys == ["01_Live_animals_and_mor", "UNKNOWN_NO_NAME", "UNKNOWN_NO_NAME"]


def test_partner_year_key_and_null_cells(spark):
    df = spark.createDataFrame([("DEU", 2020, 1.5, None), (None, 0, None, 0.25)],
                               "partnerISO string, year int, partner_value_usd double, avg_market_share double")
    rows = srv.to_serving(df, srv.partner_year_key(), "info", srv.PARTNER_CELLS).collect()
    assert rows[0].row_key == "DEU_2020" and rows[1].row_key == "UNKNOWN_0000"
    assert rows[0].cells == {"info:partner_iso": "DEU", "info:year": "2020",
                             "info:partner_value_usd": "1.50"}
    assert "info:partner_iso" not in rows[1].cells
    assert rows[1].cells["info:avg_market_share"] == "0.2500000000"


def test_cell_text_has_no_exponent(spark):
    df = spark.createDataFrame([(12345678.9,)], "v double")
    assert df.select(srv.cell_text("v", 2).alias("t")).first().t == "12345678.90"


class FileClient:
    """Stand-in for a key/value client: one JSON file per put batch."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        return self

    def put_batch(self, batch):
        name = os.path.join(self.folder, f"{os.getpid()}-{id(batch)}-{len(os.listdir(self.folder))}.json")
        with open(name, "w") as fh:
            json.dump(batch, fh)

    def close(self):
        pass


def test_executor_side_writer_batches(spark):
    folder = tempfile.mkdtemp(prefix="kv-")
    rows = spark.range(2500).select(F.col("id").cast("string").alias("k"))
    serving = srv.to_serving(rows, F.col("k"), "f", [srv.Cell("id", "k")]).repartition(2)
    srv.write_with_client(serving, FileClient(folder), batch_size=1000)
    sizes, keys = [], set()
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as fh:
            batch = json.load(fh)
        sizes.append(len(batch))
        keys |= {k for k, _ in batch}
    assert len(keys) == 2500 and max(sizes) <= 1000


def test_collisions_reported(spark):
    df = spark.createDataFrame([("Same name here is long A", "1"), ("Same name here is long B", "1")],
                               "commodity_short string, hs_code string")
    rows = srv.to_serving(df, srv.commodity_key(), "info", [srv.Cell("commodity_name", "commodity_short")])
    assert key_collisions(rows, "row_key").count() == 1


def test_peek_is_key_ordered(spark):
    df = spark.createDataFrame([(str(i), "x") for i in [5, 3, 9, 1, 7, 2]], "row_key string, v string")
    assert sorted(r.row_key for r in srv.peek(df, 3).collect()) == ["1", "2", "3"]


def _rows(spark, pairs):
    return spark.createDataFrame([(k, {"f:v": v}) for k, v in pairs], "row_key string, cells map<string,string>")


def test_a_failing_task_or_a_collision_leaves_the_published_table(spark, tmp_path):
    table = srv.PublishedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.publish(_rows(spark, [("a", "1"), ("b", "2")]))
    bad = _rows(spark, [("c", "3"), ("d", "x")]).withColumn(
        "row_key", F.when(F.col("row_key") == "d", F.raise_error(F.lit("task fails"))).otherwise(F.col("row_key")))
    with pytest.raises(PySparkException, match="task fails"):
        table.publish(bad)
    assert table.location() == first
    with pytest.raises(srv.KeyCollisionError, match="2 rows") as failure:
        table.publish(_rows(spark, [("e", "4"), ("e", "5"), ("f", "6")]))
    assert table.location() == first and sorted(r.row_key for r in table.read().collect()) == ["a", "b"]
    report = spark.read.parquet(str(failure.value).rsplit(" in ", 1)[1])
    assert sorted((r.row_key, r.cells["f:v"], r.n) for r in report.collect()) == [("e", "4", 2), ("e", "5", 2)]


def test_publishing_again_replaces_and_keeps_one_version_back(spark, tmp_path):
    table = srv.PublishedTable(spark, str(tmp_path / "t"))
    places = [table.publish(_rows(spark, [(str(i), "v")])) for i in range(12)]
    assert [r.row_key for r in table.read().collect()] == ["11"] and table.location() == places[-1]
    assert [os.path.isdir(p) for p in places[-3:]] == [False, True, True]
    assert len(table.versions()) == 2


class StagingClient:
    """Stand-in for a key/value store with staging: folders of JSON files."""

    def __init__(self, root, fail_on=None):
        self.root, self.fail_on = root, fail_on

    def __call__(self):
        return self

    def stage(self, version, batch):
        if self.fail_on and any(k == self.fail_on for k, _ in batch):
            raise RuntimeError("store refuses the row")
        folder = os.path.join(self.root, f"staged-{version}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"{batch[0][0]}.json"), "w") as fh:
            json.dump(batch, fh)

    def commit(self, version):
        with open(os.path.join(self.root, "current"), "w") as fh:
            fh.write(version)

    def abort(self, version):
        with open(os.path.join(self.root, f"aborted-{version}"), "w"):
            pass

    def close(self):
        pass


def _stored(root):
    version = open(os.path.join(root, "current")).read()
    folder = os.path.join(root, f"staged-{version}")
    return sorted(k for f in os.listdir(folder) for k, _ in json.load(open(os.path.join(folder, f))))


def test_client_rows_are_committed_or_aborted_as_one(spark, tmp_path):
    root = str(tmp_path)
    rows = _rows(spark, [(f"k{i:03}", str(i)) for i in range(250)]).repartition(3)
    version = srv.publish_with_client(rows, StagingClient(root), batch_size=40)
    assert _stored(root) == [f"k{i:03}" for i in range(250)]
    with pytest.raises(PySparkException):
        srv.publish_with_client(rows, StagingClient(root, fail_on="k100"), batch_size=40)
    assert open(os.path.join(root, "current")).read() == version  # the old table stands
    assert [n for n in os.listdir(root) if n.startswith("aborted-")]
