"""Mart compositions (flagship plans).

Shuffle budget per mart (checked with ``explain`` in tests):

* monthly features: narrow; the partner lookup is a checked broadcast.
* monthly shares: one partial-aggregate shuffle for the (period, hs) totals
  plus the join back (broadcast when small, else skew-split SMJ).
* yearly: one partial-aggregate shuffle on the 4 rollup keys, then a window
  on (year, hs) over the rolled-up rows (groups bounded by dimension
  cardinality, not by volume).
* currency / FX / indicator joins: all small, bounded sides -> broadcast,
  so the trade rows are never shuffled for them.

The year range is applied *before* the shares and the rollup.  It is
equivalent to filtering the finished mart (both share groups lie inside a
single year, because the year is a function of the period) and it keeps
unused years out of every shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.features import trade_features
from portolan.operators.fx import fx_monthly, fx_yearly
from portolan.operators.indicators import indicators_wide
from portolan.operators.filters import period_range
from portolan.operators.joins import is_small, lookup, repeated_keys, unique_side
from portolan.operators.rollup import yearly_trade
from portolan.operators.shares import share_of_total
from portolan.plans.context import MART_YEARS, Domain


def year_range(df: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    """FLT-1: inclusive year range."""
    if years is None:
        return df
    return df.filter(F.col("year").between(years[0], years[1]))


def monthly_features(d: Domain, years: tuple[int, int] | None = None) -> DataFrame:
    """Typed, conformed trade rows of the years; the range reaches the scan as a
    range of the period text."""
    base = d.features
    if base is None:
        raw = d.trade_raw if years is None else period_range(d.trade_raw, *years)
        base = trade_features(raw, d.iso_dim)
    return year_range(base, years)


def without_partners(df: DataFrame, partners: tuple[str, ...] = ()) -> DataFrame:
    """Drop aggregate partners (e.g. the world code) *before* totals, so
    they do not count in the denominators.  The default keeps every row."""
    if not partners:
        return df
    return df.filter(~F.col("partnerISO").isin(list(partners)) | F.col("partnerISO").isNull())


def trade_monthly(d: Domain, years: tuple[int, int] | None = None,
                  strategy: str = "salted", exclude_partners: tuple[str, ...] = ()) -> DataFrame:
    """Monthly features + world total per (data_period, hs_code) + share."""
    return share_of_total(without_partners(monthly_features(d, years), exclude_partners),
                          "primary_value_usd",
                          ["data_period", "hs_code"], "month_world_export_value",
                          "share_of_month_market", strategy=strategy)


def trade_yearly(d: Domain, years: tuple[int, int] | None = None,
                 strategy: str = "window", exclude_partners: tuple[str, ...] = ()) -> DataFrame:
    return yearly_trade(without_partners(monthly_features(d, years), exclude_partners),
                        strategy=strategy)


def with_currency(df: DataFrame, d: Domain) -> DataFrame:
    """J-1 / J-3: partner alpha-3 -> currency (checked broadcast lookup)."""
    return lookup(df, d.currency_dim, F.col("partnerISO"), "country_iso3", ["currency"])


def monthly_mart(d: Domain, years: tuple[int, int] | None = MART_YEARS,
                 with_shares: bool = True, strategy: str = "salted") -> DataFrame:
    """J-1, J-2, FLT-1: monthly trade + currency + monthly FX statistics.

    ``with_shares=False`` skips the month-share columns for consumers that
    do not read them (Catalyst cannot drop a left join to an aggregate on
    its own).  The currency / FX joins are left joins on unique keys, so
    consumers that read only trade columns may use ``monthly_features``
    with the same year range instead: the rows are identical.
    """
    base = trade_monthly(d, years, strategy) if with_shares else monthly_features(d, years)
    m = with_currency(base, d)
    fx = year_range(fx_monthly(d.fx_raw), years)
    return m.join(fx, on=["currency", "year", "month"], how="left")


def yearly_currency(d: Domain) -> DataFrame:
    """Yearly trade + currency, all years (feeds ranking / share views)."""
    return with_currency(trade_yearly(d), d)


def yearly_rates(d: Domain, years: tuple[int, int] | None = MART_YEARS) -> DataFrame:
    """J-3, J-4: yearly trade + currency + yearly FX statistics."""
    y = with_currency(trade_yearly(d, years), d)
    fx = year_range(fx_yearly(d.fx_raw), years)
    return y.join(fx, on=["currency", "year"], how="left")


def indicators(d: Domain) -> DataFrame:
    return indicators_wide(d.wdi_raw, d.iso_dim)


def yearly_mart(d: Domain, years: tuple[int, int] | None = MART_YEARS) -> DataFrame:
    """J-5: yearly rates ⟕ indicators on (partnerISO = countryISO3, year);
    the indicator side's year is dropped.

    The wide indicators have one row per (code, name, year); a country under two
    names would multiply trade rows, so the side's key is checked when the query
    runs (`indicator_repeats` reports such countries)."""
    y = yearly_rates(d, years)
    ind = year_range(indicators(d), years).withColumnRenamed("year", "__iyear")
    small = is_small(ind)
    ind = unique_side(ind, ["countryISO3", "__iyear"], "indicators by country and year")
    cond = (F.col("partnerISO") == F.col("countryISO3")) & (F.col("year") == F.col("__iyear"))
    return y.join(F.broadcast(ind) if small else ind, cond, "left").drop("__iyear")


def indicator_repeats(d: Domain) -> DataFrame:
    """J-5: (country, year) pairs with several indicator rows, such as a country
    under two names."""
    return repeated_keys(indicators(d), ["countryISO3", "year"])
