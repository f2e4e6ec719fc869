"""Exchange-rate preparation and statistics (PRJ-9, AGG-2/3, DQ-7/8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.columns import fixed_mean

# Central-bank rates carry at most 4-6 decimals; 8 keeps every digit while
# allowing rates up to ~9e10 in the fixed-point accumulator.
RATE_SCALE = 8


def parse_rate_dates(df: DataFrame, date_col: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text date -> ``DateType`` plus ``year`` / ``month``; unparsable text
    becomes null (ANSI-safe ``try_to_date``)."""
    d = F.try_to_date(F.col(date_col), fmt)
    return df.withColumn(date_col, d).withColumns({
        "year": F.year(date_col), "month": F.month(date_col)})


def rate_stats(df: DataFrame, keys: list[str], value: str = "rate",
               scale: int | None = None) -> DataFrame:
    """``min`` / ``max`` / mean of daily rates per key.  The mean is over
    the daily rows (not of sub-period means); with ``scale`` it is exact and
    independent of partitioning."""
    mean = fixed_mean(value, scale)
    return df.groupBy(*keys).agg(
        F.min(value).alias("min_rate"),
        F.max(value).alias("max_rate"),
        mean.alias("avg_rate"),
    )


def fx_monthly(fx_raw: DataFrame, scale: int | None = None) -> DataFrame:
    return rate_stats(parse_rate_dates(fx_raw), ["currency", "year", "month"], scale=scale)


def fx_yearly(fx_raw: DataFrame, scale: int | None = None) -> DataFrame:
    return rate_stats(parse_rate_dates(fx_raw), ["currency", "year"], scale=scale)


def bounds_violations(stats: DataFrame, tol: float = 1e-9) -> DataFrame:
    """DQ-7: rows whose mean lies outside [min, max] beyond ``tol``."""
    return stats.filter((F.col("avg_rate") < F.col("min_rate") - F.lit(tol))
                        | (F.col("avg_rate") > F.col("max_rate") + F.lit(tol)))


def unparsable_dates(df: DataFrame, date_col: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """DQ-8: rows whose date text is null or does not parse."""
    return df.filter(F.try_to_date(F.col(date_col), fmt).isNull())
