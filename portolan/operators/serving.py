"""Serving rows for a wide-column key/value store (PRJ-19, SNK-3..6, SRC-6).

A view becomes ``(row_key, cells)`` where ``cells`` maps
``family:qualifier`` to plain text; null cells are omitted.  Rows are
written from the executors -- the driver never holds them -- either as a parquet
table that is published in one step, behind a gate on colliding keys, or through
a key/value client that stages and commits, or by plain puts in batches.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from portolan.functions.columns import as_col, cell_text
from portolan.operators.views import PERCENT_DIGITS, PRICE_DIGITS, SHARE_DIGITS

MONEY_DIGITS = 2


@dataclass(frozen=True)
class Cell:
    qualifier: str
    column: str
    scale: int | None = None   # None: cast as is; int: decimal text


def _present(c, numeric: bool = False) -> Column:
    """Truthiness of a key part: not null and not '' (text) / not 0
    (numbers)."""
    col = as_col(c)
    return col.isNotNull() & ((col != 0) if numeric else (col != ""))


def key_or(c, default: str, numeric: bool = False) -> Column:
    return F.when(_present(c, numeric), as_col(c).cast("string")).otherwise(F.lit(default))


def _cells(family: str, cells: list[Cell]) -> list[tuple[str, Column]]:
    return [(f"{family}:{c.qualifier}", cell_text(c.column, c.scale)) for c in cells]


def to_serving(df: DataFrame, key: Column, family: str, cells: list[Cell]) -> DataFrame:
    """``(row_key, cells map<string,string>)``, null cells dropped."""
    pairs = []
    for name, text in _cells(family, cells):
        pairs += [F.lit(name), text]
    m = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return df.select(key.alias("row_key"), m.alias("cells"))


def to_cells(df: DataFrame, key: Column, family: str, cells: list[Cell]) -> DataFrame:
    """Long form: one row per stored cell ``(row_key, column, value)``."""
    structs = [F.struct(F.lit(n).alias("column"), t.alias("value")) for n, t in _cells(family, cells)]
    return (df.select(key.alias("row_key"), F.inline(F.array(*structs)))
            .filter(F.col("value").isNotNull()))


# -- the four views -----------------------------------------------------------

def trade_time_key() -> Column:
    return F.concat_ws("_", F.col("year").cast("string"), F.col("month").cast("string"))


TRADE_TIME_CELLS = [
    Cell("year", "year"), Cell("month", "month"),
    Cell("total_value_usd", "total_value_usd", MONEY_DIGITS),
    Cell("total_quantity", "total_quantity", MONEY_DIGITS),
    Cell("avg_unit_price", "avg_unit_price", PRICE_DIGITS),
]


def commodity_key(width: int = 20) -> Column:
    """``{hs_code or UNKNOWN}_{name stripped, spaces -> _, first 20 or
    NO_NAME}``."""
    name = F.regexp_replace(F.col("commodity_short"), r"^\s+|\s+$", "")
    name = F.substring(F.translate(name, " ", "_"), 1, width)
    name = F.when(_present("commodity_short"), name).otherwise(F.lit("NO_NAME"))
    return F.concat(key_or("hs_code", "UNKNOWN"), F.lit("_"), name)


COMMODITY_CELLS = [
    Cell("commodity_name", "commodity_short"), Cell("hs_code", "hs_code"),
    Cell("total_value_usd", "total_value_usd", MONEY_DIGITS),
    Cell("total_quantity", "total_quantity", MONEY_DIGITS),
    Cell("avg_unit_price", "avg_unit_price", PRICE_DIGITS),
]


def partner_year_key() -> Column:
    return F.concat(key_or("partnerISO", "UNKNOWN"), F.lit("_"), key_or("year", "0000", numeric=True))


PARTNER_CELLS = [
    Cell("partner_iso", "partnerISO"), Cell("year", "year"),
    Cell("partner_value_usd", "partner_value_usd", MONEY_DIGITS),
    Cell("avg_market_share", "avg_market_share", SHARE_DIGITS),
]


def partner_key() -> Column:
    return key_or("partnerISO", "UNKNOWN")


ECONOMIC_CELLS = [
    Cell("partner_iso", "partnerISO"),
    Cell("industry_share", "industry_share", PERCENT_DIGITS),
    Cell("services_share", "services_share", PERCENT_DIGITS),
    Cell("trade_share", "trade_share", PERCENT_DIGITS),
    Cell("trade_value", "trade_value", MONEY_DIGITS),
]


def rate_week_key() -> Column:
    """``{currency}_{week start yyyy-MM-dd}`` for the weekly rate table."""
    return F.concat(key_or("currency", "UNKNOWN"), F.lit("_"), F.col("week_start").cast("string"))


def rate_month_key() -> Column:
    return F.concat(key_or("currency", "UNKNOWN"), F.lit("_"),
                    F.date_format("month_start", "yyyy-MM"))


RATE_CELLS = [
    Cell("min_rate", "min_rate", 8), Cell("max_rate", "max_rate", 8),
    Cell("avg_rate", "avg_rate", 8), Cell("n_rates", "n_rates"),
]


def colliding_rows(rows: DataFrame, key: str = "row_key", n_as: str = "n") -> DataFrame:
    """The rows whose key occurs more than once, with the number of rows that
    share it.  The keys are counted with partial aggregation and few remain, so
    a hot key is no window of its own."""
    several = (rows.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias(n_as))
               .filter(F.col(n_as) > 1))
    return rows.join(several, F.col(key).eqNullSafe(F.col("__k"))).drop("__k")


# -- writers and readers ------------------------------------------------------

def peek(rows: DataFrame, k: int = 5) -> DataFrame:
    """SRC-6: the first ``k`` row keys in key order with all their cells
    (a top-k, then a semi join back -- no full sort of the table)."""
    first = rows.select("row_key").distinct().orderBy("row_key").limit(k)
    return rows.join(F.broadcast(first), "row_key", "left_semi")


class KeyCollisionError(ValueError):
    """Several rows of a serving table have one key."""


class PublishedTable:
    """SNK-3..6: a serving table that is replaced in one step.

    Rows are written to a folder of their own (``version=<id>``), the gate looks
    at what was written, and only then a mark ``_current/<number>-<id>`` makes it
    the table: the creation of one empty folder, which happens or does not.  A
    failing task, a collision or a lost driver leaves the table as it was.  The
    version before stays for readers that are on the way; older ones go.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[str]:
        """The versions that were the table, oldest first."""
        marks = sorted(self._names("_current"), key=lambda m: int(m.split("-", 1)[0]))
        return [m.split("-", 1)[1] for m in marks]

    def location(self, version: str | None = None) -> str:
        """The folder of a version; of the current one by default."""
        if version is None:
            published = self.versions()
            if not published:
                raise FileNotFoundError(f"nothing is published at {self.path}")
            version = published[-1]
        return f"{self.path}/version={version}"

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.location())

    def stage(self, rows: DataFrame) -> str:
        """Writes a version that is not yet the table; returns its name."""
        version = uuid.uuid4().hex[:12]
        rows.write.mode("errorifexists").parquet(self.location(version))
        return version

    def check(self, version: str, key: str = "row_key") -> None:
        """Raises `KeyCollisionError` if rows of the written version share a key;
        the rows are then in ``_collisions/version=<id>``."""
        report = f"{self.path}/_collisions/version={version}"
        seen = Observation(f"collisions-{version}")
        shared = colliding_rows(self.spark.read.parquet(self.location(version)), key)
        shared.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(report)
        rows = int(seen.get["rows"])
        if rows:
            raise KeyCollisionError(f"{rows} rows of {self.location(version)} share a key; they are in {report}")

    def switch(self, version: str) -> None:
        """Makes a staged version the table."""
        marks = self._names("_current")
        number = max((int(m.split("-", 1)[0]) for m in marks), default=0) + 1
        fs, mark = self._fs(f"{self.path}/_current/{number}-{version}")
        if not fs.mkdirs(mark):
            raise OSError(f"cannot create {mark}")
        for old in self.versions()[:-2]:
            fs.delete(self._fs(self.location(old))[1], True)
        for mark_name in sorted(self._names("_current"), key=lambda m: int(m.split("-", 1)[0]))[:-2]:
            fs.delete(self._fs(f"{self.path}/_current/{mark_name}")[1], True)

    def publish(self, rows: DataFrame, key: str = "row_key") -> str:
        """Stage, gate, switch; returns the folder of the new version."""
        version = self.stage(rows)
        self.check(version, key)
        self.switch(version)
        return self.location(version)


class ClientPublisher(DataSource):
    """A data source that writes through a key/value client in one step.

    The client stages a task's rows under a version (``stage(version, batch)``);
    when all tasks are done ``commit(version)`` makes them the table, and if one
    fails ``abort(version)`` drops what was staged."""

    @classmethod
    def name(cls) -> str:
        return "portolan_client"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _ClientWriter(self.options)


class _ClientWriter(DataSourceWriter):
    def __init__(self, options) -> None:
        self.factory = cloudpickle.loads(base64.b64decode(options["factory"]))
        self.batch_size, self.version = int(options["batch_size"]), options["version"]

    def write(self, iterator) -> WriterCommitMessage:
        client = self.factory()
        try:
            batch = []
            for row in iterator:
                batch.append((row["row_key"], dict(row["cells"])))
                if len(batch) >= self.batch_size:
                    client.stage(self.version, batch)
                    batch = []
            if batch:
                client.stage(self.version, batch)
        finally:
            client.close()
        return WriterCommitMessage()

    def _finish(self, step: str) -> None:
        client = self.factory()
        try:
            getattr(client, step)(self.version)
        finally:
            client.close()

    def commit(self, messages) -> None:
        self._finish("commit")

    def abort(self, messages) -> None:
        self._finish("abort")


def publish_with_client(rows: DataFrame, client_factory: Callable[[], object], batch_size: int = 1000) -> str:
    """Replace a key/value table with ``rows`` (``row_key``, ``cells``) in one step;
    returns the version.  ``client_factory()`` must return an object with
    ``stage(version, list[(row_key, dict)])``, ``commit(version)``,
    ``abort(version)`` and ``close()``.  A retried task stages its rows again, so
    staging must be keyed by row."""
    spark, version = rows.sparkSession, uuid.uuid4().hex[:12]
    spark.dataSource.register(ClientPublisher)
    (rows.select("row_key", "cells").write.format(ClientPublisher.name()).mode("append")
     .option("factory", base64.b64encode(cloudpickle.dumps(client_factory)).decode())
     .option("batch_size", str(batch_size)).option("version", version).save())
    return version


def write_with_client(rows: DataFrame, client_factory: Callable[[], object],
                      batch_size: int = 1000) -> None:
    """Executor-side writer: each task opens one client and sends ``put``
    batches of ``batch_size`` rows.  ``client_factory()`` must return an
    object with ``put_batch(list[(row_key, dict)])`` and ``close()``; it is
    pickled to the executors.  A retried task re-sends its rows, which is
    idempotent for keyed puts."""
    def run(it):
        client = client_factory()
        try:
            batch = []
            for r in it:
                batch.append((r["row_key"], dict(r["cells"])))
                if len(batch) >= batch_size:
                    client.put_batch(batch)
                    batch = []
            if batch:
                client.put_batch(batch)
        finally:
            client.close()
    rows.foreachPartition(run)
