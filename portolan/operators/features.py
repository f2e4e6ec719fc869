"""Row-level trade features (narrow projections, no shuffle)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.columns import (
    guarded_ratio,
    period_month,
    period_year,
    quarter_label,
    quarter_of,
)
from portolan.operators.joins import lookup
from portolan.schemas import PARTNER_ALIASES_UNIDENTIFIED, UNIDENTIFIED

MEASURES = ("quantity", "weight", "primary_value_usd")


def cast_columns(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """PRJ-1 / PRJ-2: ``try_cast`` columns (bad text -> null)."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """DQ-3: per-column fill; on doubles NaN is filled as well as null."""
    return df.fillna(defaults)


def conform_partner(df: DataFrame, iso_dim: DataFrame, code_col: str = "partner_code",
                    out_col: str = "partnerISO",
                    aliases: Iterable[str] = PARTNER_ALIASES_UNIDENTIFIED,
                    default: str = UNIDENTIFIED) -> DataFrame:
    """PRJ-3 / PRJ-4 / J-6: numeric partner code -> alpha-3.

    A broadcast lookup on ``try_cast(code as int)`` replaces a per-row
    Python function: null, blank, non-numeric, zero and unknown codes all
    become ``default``; listed alias codes are folded into ``default`` too.
    """
    key = F.trim(F.col(code_col)).try_cast("int")
    out = lookup(df, iso_dim, key, "iso_numeric", [F.col("iso3").alias("__iso3")])
    iso = F.coalesce(F.col("__iso3"), F.lit(default))
    aliases = list(aliases)
    if aliases:
        iso = F.when(iso.isin(aliases), F.lit(default)).otherwise(iso)
    return out.withColumn(out_col, iso).drop("__iso3")


def unit_values(df: DataFrame, value: str = "primary_value_usd", quantity: str = "quantity",
                weight: str = "weight", unit_as: str = "unit_value_usd",
                per_kg_as: str = "usd_per_kg") -> DataFrame:
    """PRJ-6 / PRJ-7: guarded value-per-unit and value-per-kg."""
    return df.withColumns({
        unit_as: guarded_ratio(value, quantity),
        per_kg_as: guarded_ratio(value, weight),
    })


def period_features(df: DataFrame, period: str = "data_period") -> DataFrame:
    """PRJ-8: year, month (annual periods -> 1), quarter, quarter label."""
    return (df.withColumns({"year": period_year(period), "month": period_month(period)})
            .withColumn("quarter", quarter_of("month"))
            .withColumn("quarter_label", quarter_label("quarter")))


def trade_features(trade_raw: DataFrame, iso_dim: DataFrame) -> DataFrame:
    """Cast, conform partner, fill, ratios, period parts -- all narrow
    (one broadcast lookup), so the whole chain is one codegen stage."""
    df = cast_columns(trade_raw, MEASURES)
    df = conform_partner(df, iso_dim)
    df = fill_defaults(df, {"quantity": 0.0, "weight": 0.0})
    df = unit_values(df)
    return period_features(df)
