"""Lineage cuts as written tables in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.session import scratch_path

#: A side of a join is broadcast only when its written table has at most this
#: many rows of a few longs each (tens of MB in memory); beyond it the planner
#: shuffles.
BROADCAST_ROWS = 200_000

#: Removes a query's shuffle files when the query is done; a written table
#: never needs those that it came from.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: later plans start
    from files that every executor sees, so a lost executor recomputes only
    its own tasks."""
    return Table(df.sparkSession, name).write(df).read()


#: Tables written on the way to a result that is being settled.
_ON_THE_WAY: ContextVar[list | None] = ContextVar("portolan_tables_on_the_way", default=None)


def settled(build: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """The result of ``build``, written and read back; the tables that it wrote
    on the way are dropped then, and if it fails."""
    tables: list[Table] = []
    token = _ON_THE_WAY.set(tables)
    try:
        result = build()
    finally:
        _ON_THE_WAY.reset(token)
    try:
        return cut(result, name)
    finally:
        for table in tables:
            table.drop()


class Table:
    """An intermediate table that can be dropped once nothing reads it."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path, self.schema = spark, scratch_path(spark, f"llm-{name}"), None
        if (tables := _ON_THE_WAY.get()) is not None:
            tables.append(self)

    def write(self, df: DataFrame) -> Table:
        self.schema = df.schema
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(self.path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its known row count is within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def unused(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has (case does not tell names apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
