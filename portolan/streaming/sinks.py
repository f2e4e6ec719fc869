"""Tables that micro-batches write (STR-5).

A table is a folder of batches and snapshots::

    <path>/batch_id=<n>/              what batch n wrote
    <path>/_folds/upto=<n>/           the table after batch n, folded

Batch n is written with overwrite, so a batch replayed after a failure
(Structured Streaming re-runs the last uncommitted batch with the same id)
replaces its own output.  Every ``fold_every`` batches the newest whole snapshot
and the batches behind it are folded into a new snapshot; once it is complete,
what the snapshot before it holds is removed.  That older snapshot and the batches
behind it stay, for readers that are on the way and for a replay of the last
batch.  A reader takes the newest complete snapshot (the
one with a ``_SUCCESS`` mark) and the batches behind it, so a crash at any point
leaves a readable table, and the number of folders is bounded however many
batches ran.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.session import path_status

BATCH_COL = "batch_id"
FOLD_EVERY = 32
FOLDS = "_folds"

Merge = Callable[[DataFrame], DataFrame]


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, path: str, prefix: str, complete: bool = False) -> list[int]:
    """The n of the folders ``<prefix>=<n>`` of a path, ascending."""
    fs, p = _files(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(f"{prefix}=") and (
                not complete or fs.exists(_files(spark, f"{path}/{name}/_SUCCESS")[1])):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


class BatchTable:
    """A folder of batches with folds.  ``merge`` reduces rows (with the column
    ``batch_id``) to the table's state in the same columns; without it batches
    are rows to keep, and nothing is folded."""

    def __init__(self, path: str, merge: Merge | None = None, fold_every: int = FOLD_EVERY) -> None:
        self.path, self.merge, self.fold_every = path.rstrip("/"), merge, fold_every

    def write(self, rows: DataFrame, batch_id: int, partition_by: str | None = None) -> None:
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.path}/{BATCH_COL}={batch_id}")

    def read(self, spark: SparkSession, schema: T.StructType | None = None, upto: int | None = None) -> DataFrame:
        """The rows of the newest complete snapshot (of ``upto`` at most) and of
        the batches behind it, with the batch they come from."""
        folds = [n for n in _numbers(spark, f"{self.path}/{FOLDS}", "upto", complete=True) if upto is None or n <= upto]
        after = folds[-1] if folds else -1
        batches = [n for n in _numbers(spark, self.path, BATCH_COL) if n > after and (upto is None or n <= upto)]
        parts = []
        if folds:
            snapshot = spark.read.parquet(f"{self.path}/{FOLDS}/upto={after}")
            parts.append(snapshot.withColumn(BATCH_COL, F.lit(after)))
        if batches:
            parts.append(spark.read.option("basePath", self.path).parquet(
                *[f"{self.path}/{BATCH_COL}={n}" for n in batches]))
        if not parts:
            if schema is None:
                raise FileNotFoundError(f"no batch in {self.path}")
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BATCH_COL, T.IntegerType())]))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def state(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        rows = self.read(spark, schema)
        return self.merge(rows) if self.merge else rows.drop(BATCH_COL)

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """A snapshot of the table after ``batch_id``; then what it replaces goes."""
        done = _numbers(spark, f"{self.path}/{FOLDS}", "upto", complete=True)
        if batch_id not in done:
            self.merge(self.read(spark, upto=batch_id)).write.mode("overwrite").parquet(
                f"{self.path}/{FOLDS}/upto={batch_id}")
        self.tidy(spark)

    def tidy(self, spark: SparkSession) -> None:
        """Removes what the complete snapshot before the newest holds.  That one
        and the batches behind it stay: a reader may be on the way through them,
        and a replayed batch reads the table as it was before the batch."""
        folds = _numbers(spark, f"{self.path}/{FOLDS}", "upto", complete=True)
        if len(folds) < 2:
            return
        for n in _numbers(spark, self.path, BATCH_COL):
            if n <= folds[-2]:
                _remove(spark, f"{self.path}/{BATCH_COL}={n}")
        for n in _numbers(spark, f"{self.path}/{FOLDS}", "upto"):
            if n < folds[-2]:
                _remove(spark, f"{self.path}/{FOLDS}/upto={n}")

    def commit(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch: written, and folded when it is due.  A replayed batch
        that a snapshot already holds is not written again."""
        spark = rows.sparkSession
        folds = _numbers(spark, f"{self.path}/{FOLDS}", "upto", complete=True)
        if self.merge and folds and folds[-1] >= batch_id:
            self.tidy(spark)
            return
        self.write(rows, batch_id)
        if self.merge and (batch_id + 1) % self.fold_every == 0:
            self.fold(spark, batch_id)


def latest_by(keys: list[str]) -> Merge:
    """Per key, the row of the highest batch."""
    def merge(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in keys and c != BATCH_COL]
        newest = F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("__v")
        return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])
    return merge


class UpsertSink:
    """``foreachBatch`` of an update-mode query: per key the newest row counts."""

    def __init__(self, path: str, keys: list[str], fold_every: int = FOLD_EVERY) -> None:
        self.table = BatchTable(path, latest_by(keys), fold_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.table.commit(batch, batch_id)


class AppendSink:
    """``foreachBatch`` of an append-only table."""

    def __init__(self, path: str) -> None:
        self.table = BatchTable(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.table.write(batch, batch_id)


class Ledger:
    """Event times seen so far, one row per micro-batch in the shared folder.

    The watermark of batch n is the greatest event time of the batches before n,
    less the delay: what a replayed batch n reads is what it read the first time,
    so late rows are told apart the same way again.  ``rows`` of every batch are
    kept beside it; ledger rows are folded like any table."""

    SCHEMA = T.StructType([T.StructField("__one", T.IntegerType()), T.StructField("event_time", T.TimestampType()),
                           T.StructField("rows", T.LongType())])

    def __init__(self, path: str, delay: str, fold_every: int = FOLD_EVERY) -> None:
        self.delay = delay
        self.table = BatchTable(path, lambda rows: rows.groupBy("__one").agg(
            F.max("event_time").alias("event_time"), F.sum("rows").alias("rows")), fold_every)

    def watermark(self, spark: SparkSession, batch_id: int):
        """The watermark before ``batch_id``: a timestamp, or null before any row."""
        seen = self.table.read(spark, self.SCHEMA, upto=batch_id - 1)
        edge = F.max("event_time") - F.expr(f"interval {self.delay}")
        return seen.agg(edge.alias("w")).first()["w"]

    def note(self, batch: DataFrame, batch_id: int, time_col: str) -> None:
        self.table.commit(batch.agg(F.lit(1).alias("__one"), F.max(time_col).alias("event_time"),
                                    F.count(F.lit(1)).alias("rows")), batch_id)


def read_latest(spark: SparkSession, path: str, keys: list[str],
                schema: T.StructType | None = None) -> DataFrame:
    """Current state of an upsert table: per key, the row of the newest batch."""
    return BatchTable(path, latest_by(keys)).state(spark, schema)


def read_appended(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  where: str | None = None) -> DataFrame:
    """Rows of an append-only table; ``where`` picks folders of its partition."""
    if path_status(spark, path) == "missing" and schema is None:
        raise FileNotFoundError(path)
    rows = BatchTable(path).read(spark, schema).drop(BATCH_COL)
    return rows.filter(where) if where else rows
