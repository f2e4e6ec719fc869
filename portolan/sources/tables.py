"""Readers for parquet inputs.

Readers are lazy: they only build a scan, so column pruning and filter
pushdown reach the parquet files once the consuming plan is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan import schemas

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Schemas of the driver tables: reading one is a job.  Files are listed anew by
# every accessor, so a table that grows is read whole.
_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


class Tables:
    """Lazy accessor for the parquet tables of one folder: ``t.lineitem``.  Each
    table is listed once per accessor (a scan keeps the files it found)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._scans:
            known = (self.spark.sparkContext.applicationId, self.path(name))
            if known not in _SCHEMAS:
                _SCHEMAS[known] = self.spark.read.parquet(self.path(name)).schema
            self._scans[name] = self.spark.read.schema(_SCHEMAS[known]).parquet(self.path(name))
        return self._scans[name]


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: missing columns fail loudly, extra columns are
    dropped, and every column goes through ``try_cast`` so bad text becomes
    null instead of failing the job (ANSI is on)."""
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"input lacks columns {absent}")
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name)
                      for f in schema.fields])


def read_trade(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: trade records, measures as double."""
    return _typed(spark.read.parquet(path), schemas.TRADE_RAW)


def read_fx(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: daily rates; ``date`` stays text until ``parse_rate_dates``."""
    return _typed(spark.read.parquet(path), schemas.FX_RAW)


def read_indicators(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-3: many long-form indicator files by glob; ``year`` int,
    ``value`` double."""
    return _typed(spark.read.parquet(glob), schemas.WDI_TYPED)


def read_mart(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """SRC-5: a written mart; a year range prunes ``year=`` partitions."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.filter(F.col("year").between(years[0], years[1]))
    return df
