"""Reference dimensions (SRC-4, SNK-2).

The country -> currency dimension ships with the package (182 fixed rows,
``portolan/data/currency_dim.csv``).  It is a constant, so it is parsed on
the driver and handed to Spark with ``createDataFrame``; every lookup then
broadcasts it after the usual size / uniqueness check.

The numeric-code -> ISO alpha-2 / alpha-3 table is *not* shipped: it is a
standard code list (ISO 3166-1) that deployments load from their own
reference data with ``read_code_table``.
"""

from __future__ import annotations

import csv
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan import schemas

DATA_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data")
CURRENCY_CSV = os.path.join(DATA_DIR, "currency_dim.csv")


def currency_rows(path: str = CURRENCY_CSV) -> list[tuple[str, str | None]]:
    with open(path, newline="") as fh:
        lines = [ln for ln in fh if not ln.startswith("#")]
    reader = csv.DictReader(lines)
    return [(r["country_iso3"], r["currency"] or None) for r in reader]


def currency_dimension(spark: SparkSession, path: str = CURRENCY_CSV) -> DataFrame:
    """The packaged country -> currency dimension (unique country keys)."""
    rows = currency_rows(path)
    keys = [k for k, _ in rows]
    if len(set(keys)) != len(keys):
        raise ValueError("currency dimension has duplicate country keys")
    # an Arrow table becomes constant rows of a known size, which a join may broadcast
    return spark.createDataFrame(pa.table({"country_iso3": keys, "currency": [c for _, c in rows]}),
                                 schemas.CURRENCY_DIM)


def read_code_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """ISO numeric / alpha-2 / alpha-3 table from a shared location
    (columns ``iso_numeric``, ``iso2``, ``iso3``); a lookup by one of the keys
    raises if it is not unique."""
    return spark.read.format(fmt).option("header", "true").load(path).select(
        F.col("iso_numeric").try_cast("int").alias("iso_numeric"),
        F.col("iso2").cast("string").alias("iso2"),
        F.col("iso3").cast("string").alias("iso3"))


def write_dimension(df: DataFrame, path: str) -> None:
    """SNK-2: overwrite a dimension table (one small file)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
