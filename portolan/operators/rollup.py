"""Yearly rollup of monthly trade rows (AGG-1, PRJ-7, WIN-3/4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from portolan.functions.columns import fixed_sum
from portolan.operators.features import unit_values
from portolan.operators.shares import share_of_total

YEAR_KEYS = ["year", "partnerISO", "commodity_desc", "hs_code"]


def rollup_sums(df: DataFrame, keys: list[str], measures: dict[str, str],
                scale: int | None = None) -> DataFrame:
    """``groupBy(keys)`` and sum each source column into its output name.

    Hash aggregation with map-side partial sums: the shuffle carries one
    row per key per task, whatever the input volume.
    """
    return df.groupBy(*keys).agg(*[fixed_sum(src, scale).alias(dst) for dst, src in measures.items()])


def yearly_trade(monthly: DataFrame, strategy: str = "window", scale: int | None = None) -> DataFrame:
    """Yearly rows: sums, ratios recomputed from the sums (not averaged),
    world total per (year, hs_code) and the share of the year's market.

    The world total is a window over the *rolled-up* rows: after the 4-key
    aggregation a (year, hs_code) group holds at most one row per
    (partner, description) pair, a bound set by the dimensions rather than
    by the data volume, so the window is skew-safe and the input is read
    once (a join strategy would recompute the rollup for the totals).
    """
    y = rollup_sums(monthly, YEAR_KEYS, {
        "annual_value_usd": "primary_value_usd",
        "quantity": "quantity",
        "weight": "weight",
    }, scale)
    y = unit_values(y, value="annual_value_usd")
    return share_of_total(y, "annual_value_usd", ["year", "hs_code"],
                          "world_export_value", "share_of_year_market",
                          strategy=strategy, scale=scale)
