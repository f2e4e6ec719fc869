"""Filters (FLT-1..6) beyond plain ``filter`` expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.joins import bounded_broadcast


def year_range(df: DataFrame, lo: int, hi: int, col: str = "year") -> DataFrame:
    """FLT-1: inclusive range (pushed into scans / partition pruning)."""
    return df.filter(F.col(col).between(lo, hi))


def period_range(df: DataFrame, lo: int, hi: int, period: str = "data_period") -> DataFrame:
    """FLT-1 at the scan: the rows whose period text (``YYYY`` or ``YYYYMM``)
    can lie in the years.  Four digits sort as text as they do as numbers, so
    this is a plain range that reaches the files; ``year_range`` behind it
    decides."""
    if not 1000 <= lo <= hi <= 9998:
        return df
    return df.filter((F.col(period) >= str(lo)) & (F.col(period) < str(hi + 1)))


def members(df: DataFrame, col: str, values) -> DataFrame:
    """FLT-2: keep rows whose ``col`` is in ``values``.

    A Python list becomes an ``IN`` predicate (pushed to parquet); a
    DataFrame of values becomes a left-semi join, broadcast within its
    checked bound (long lists)."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias("__m")).distinct()
        return df.join(bounded_broadcast(keys), F.col(col) == F.col("__m"), "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def exclude(df: DataFrame, col: str, value, keep_null: bool = False) -> DataFrame:
    """FLT-4: drop rows equal to ``value``.  SQL ``!=`` also drops nulls;
    ``keep_null=True`` keeps them (the list-comprehension behaviour)."""
    cond = F.col(col) != value
    if keep_null:
        cond = cond | F.col(col).isNull()
    return df.filter(cond)
