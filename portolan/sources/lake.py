"""Lake layout and table writers (SNK-1, SNK-7).

Tables are directories of parquet files written with ``overwrite`` (an
idempotent re-run replaces the table; nothing is moved or deleted by hand).
Marts are partitioned by ``year`` so readers filtering a year range only
list and read those partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from portolan.session import scratch_path

# Caps file size without an extra shuffle: a writer task rolls to a new file
# after this many rows.
MAX_RECORDS_PER_FILE = 5_000_000

# Files that a task keeps open in a partitioned write, and what each of them
# holds in memory at most (a row group).
OPEN_FILES, OPEN_FILE_BYTES = 24, 32 << 20
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


# Zone folder names of the lake layout.
TRADE_ZONE, RATES_ZONE, INDICATORS_ZONE, DIM_ZONE, FINAL_ZONE = (
    "comtrade", "NBP", "WDI", "dim", "final_tables")


@dataclass(frozen=True)
class LakePaths:
    """One root, one folder per zone (raw inputs, dimensions, final tables)."""

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def trade(self) -> str:
        return self._p(TRADE_ZONE)

    @property
    def rates(self) -> str:
        return self._p(RATES_ZONE)

    @property
    def indicators(self) -> str:
        return self._p(INDICATORS_ZONE)

    @property
    def dims(self) -> str:
        return self._p(DIM_ZONE)

    @property
    def final(self) -> str:
        return self._p(FINAL_ZONE)

    def table(self, name: str) -> str:
        return self._p(FINAL_ZONE, name)

    def serving(self, name: str) -> str:
        return self._p(FINAL_ZONE, "serving", name)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                max_records_per_file: int = MAX_RECORDS_PER_FILE,
                single_file: bool = False) -> None:
    """SNK-1: overwrite ``path`` with ``df``.

    With ``partition_by`` a task keeps a file open for each of up to
    ``OPEN_FILES`` partitions, so its rows need no sort; only a task that meets
    more partitions sorts what is left.  There is no repartition (a hot year
    would otherwise land in one task).
    ``single_file`` (``coalesce(1)``) is an opt-in for tiny outputs only: it
    funnels the whole table through one task.
    """
    spark = df.sparkSession
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite").options(
        maxRecordsPerFile=max_records_per_file, compression="zstd")
    if not partition_by:
        writer.parquet(path)
        return
    before = spark.conf.get(_OPEN_FILES, "0")
    spark.conf.set(_OPEN_FILES, str(OPEN_FILES))
    try:
        writer.option("parquet.block.size", OPEN_FILE_BYTES).partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(_OPEN_FILES, before)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once under the shared checkpoint folder
    (``spark.checkpoint.dir``) and return the table read back.  One pass,
    unlike an uncached ``checkpoint()`` which computes its input twice."""
    return materialize_counted(df, name, partition_by)[0]


def materialize_counted(df: DataFrame, name: str,
                        partition_by: list[str] | None = None) -> tuple[DataFrame, int]:
    """``materialize`` plus the exact row count, observed during the write
    itself (an ``Observation`` metric: no extra job)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"rows-{name}")
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by)
    rows = int(obs.get["rows"])
    # the known schema avoids a footer read and works for an empty table
    # (partition columns come last, as with inference)
    return spark.read.schema(df.schema).parquet(path), rows
