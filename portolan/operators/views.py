"""Serving views (AGG-5..8, SRT-2).

Means are plain row means (unweighted, as defined by the domain) and totals
plain sums; within `exact_digits` totals are exact and means rounded.  The trailing sort is descending on the measure
with the group keys as tie-break, so the order is total; ``ordered=False`` leaves it out, for consumers that key the
rows anyway (a serving table needs no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions.columns import exact_mode, fixed_sum, guarded_ratio, text_head
from portolan.operators.filters import exclude

PRICE_DIGITS = 6
SHARE_DIGITS = 10
PERCENT_DIGITS = 8


def _rounded(c, digits: int):
    """Rounded within `exact_digits` only (comparison with another engine)."""
    return F.round(c, digits) if exact_mode() else c


def _mean(c: str, digits: int):
    return _rounded(F.avg(c), digits)


def _sorted(df: DataFrame, ordered: bool, *order) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def trade_time_view(monthly: DataFrame, weighted: bool = False, ordered: bool = True) -> DataFrame:
    """Totals by (year, month) over all monthly trade rows.

    The domain's ``avg_unit_price`` is the unweighted mean of row unit
    values; ``weighted=True`` gives total value / total quantity instead
    (guarded), under the same column name."""
    price = (guarded_ratio("total_value_usd", "total_quantity") if weighted
             else None)
    out = monthly.groupBy("year", "month").agg(
        fixed_sum("primary_value_usd").alias("total_value_usd"),
        fixed_sum("quantity").alias("total_quantity"),
        *([] if weighted else [_mean("unit_value_usd", PRICE_DIGITS).alias("avg_unit_price")]))
    if weighted:
        out = out.withColumn("avg_unit_price", _rounded(price, PRICE_DIGITS))
    return _sorted(out, ordered, F.desc("total_value_usd"), "year", "month")


def commodity_ranking_view(yearly: DataFrame, ordered: bool = True) -> DataFrame:
    """Totals by (short commodity name, hs_code) over yearly rows; the mean
    unit price averages the yearly unit values."""
    out = (yearly.withColumn("commodity_short", text_head("commodity_desc"))
           .groupBy("commodity_short", "hs_code").agg(
               fixed_sum("annual_value_usd").alias("total_value_usd"),
               fixed_sum("quantity").alias("total_quantity"),
               _mean("unit_value_usd", PRICE_DIGITS).alias("avg_unit_price")))
    return _sorted(out, ordered, F.desc("total_value_usd"), "commodity_short", "hs_code")


def partner_share_view(yearly: DataFrame, world: str = "W00", ordered: bool = True) -> DataFrame:
    """Per (partner, year): value and mean share across commodities,
    world aggregate excluded (``!=`` also drops null partners)."""
    out = (exclude(yearly, "partnerISO", world)
           .groupBy("partnerISO", "year").agg(
               fixed_sum("annual_value_usd").alias("partner_value_usd"),
               _mean("share_of_year_market", SHARE_DIGITS).alias("avg_market_share")))
    return _sorted(out, ordered, F.desc("avg_market_share"), "partnerISO", "year")


def economic_structure_view(yearly_mart: DataFrame, ordered: bool = True) -> DataFrame:
    """Per partner: mean industry / services / trade share of GDP over the
    mart rows, and the traded value."""
    out = yearly_mart.groupBy("partnerISO").agg(
        _mean("industry_in_gdp", PERCENT_DIGITS).alias("industry_share"),
        _mean("services_in_gdp", PERCENT_DIGITS).alias("services_share"),
        _mean("trade_in_gdp", PERCENT_DIGITS).alias("trade_share"),
        fixed_sum("annual_value_usd").alias("trade_value"))
    return _sorted(out, ordered, F.desc("trade_value"), "partnerISO")


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """SRT-3: first ``k`` rows by a total order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)
