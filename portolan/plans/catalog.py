"""Registered queries: name -> ``f(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` through the adapter and
runs over whole tables; none caps, samples or subsets rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.functions.columns import exact_digits
from portolan.operators import features as feat
from portolan.operators import fx as fxo
from portolan.operators import indicators as ind
from portolan.operators import quality as dq
from portolan.operators import serving as srv
from portolan.operators import series as ser
from portolan.operators import views as vw
from portolan.operators.filters import period_range
from portolan.operators.joins import Step, join_accounting, key_collisions, repeated_keys
from portolan.plans import marts
from portolan.plans.context import Domain
from portolan.plans.params import (
    AUDIT_ENTITY,
    LISTED_INDICATORS,
    PEEK_K,
    QUERY_YEARS,
    SERIES_COUNTRIES,
    SERIES_CURRENCY,
    SERIES_PARTNER,
    SERIES_YEAR,
    TOP_K,
)
from portolan.schemas import INDICATOR_NAMES
from portolan.session import scratch_path
from portolan.sources.dimensions import read_code_table, write_dimension
from portolan.sources.lake import LakePaths, write_table
from portolan.sources.tables import read_fx, read_indicators, read_mart, read_trade

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the driver tables hold money of 2 decimals and rates of 7
            with exact_digits(money=2, rates=8):
                return fn(Domain(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        run.plan = fn
        QUERIES[name] = run
        return fn
    return deco


@query("trade_yearly")
def trade_yearly(d: Domain) -> DataFrame:
    """Flagship: yearly rollup, ratios, world total and share per
    (year, hs_code)."""
    return marts.trade_yearly(d)


# -- data quality ------------------------------------------------------------
def _cast(d: Domain) -> DataFrame:
    return feat.cast_columns(d.trade_raw, feat.MEASURES)


@query("trade_features")
def trade_features(d: Domain) -> DataFrame:
    """PRJ-1/3/6/8: typed, conformed, filled trade rows with period parts."""
    return marts.monthly_features(d)


@query("trade_missing_report")
def trade_missing_report(d: Domain) -> DataFrame:
    """DQ-1/2: missing values per column after the numeric casts."""
    return dq.missing_report(_cast(d))


@query("trade_fill")
def trade_fill(d: Domain) -> DataFrame:
    """DQ-3: quantity / weight filled with 0 (null and NaN)."""
    return feat.fill_defaults(_cast(d), {"quantity": 0.0, "weight": 0.0})


@query("trade_summary")
def trade_summary(d: Domain) -> DataFrame:
    """DQ-4: count, mean, deviation, bounds and exact quantiles of quantity,
    weight and value (mean and deviation rounded for the comparison)."""
    return dq.numeric_summary(trade_fill(d), ["quantity", "weight", "primary_value_usd"], scale=2, digits=4)


@query("trade_stats")
def trade_stats(d: Domain) -> DataFrame:
    """DQ-4, one pass: count, exact mean, min and max of the filled measures."""
    return dq.numeric_stats(trade_fill(d), ["quantity", "weight", "primary_value_usd"], scale=2)


@query("distinct_periods")
def distinct_periods(d: Domain) -> DataFrame:
    """DQ-5: distinct period parts."""
    return dq.distinct_values(marts.monthly_features(d),
                              ["data_period", "year", "month", "quarter", "quarter_label"])


@query("year_range")
def year_range(d: Domain) -> DataFrame:
    """DQ-6: year range of the trade rows."""
    return dq.range_check(marts.monthly_features(d), "year")


@query("fx_bounds_violations")
def fx_bounds_violations(d: Domain) -> DataFrame:
    """DQ-7: yearly FX rows with a mean outside [min, max]."""
    return fxo.bounds_violations(fxo.fx_yearly(d.fx_raw))


@query("fx_bad_dates")
def fx_bad_dates(d: Domain) -> DataFrame:
    """DQ-8: FX rows whose date does not parse."""
    return fxo.unparsable_dates(d.fx_raw)


@query("world_reconciliation")
def world_reconciliation(d: Domain) -> DataFrame:
    """DQ-9: reported world value vs. sum over the other partners."""
    return dq.world_reconciliation(marts.trade_yearly(d))


@query("entity_audit")
def entity_audit(d: Domain) -> DataFrame:
    """DQ-10: one country's indicator rows with count and year range."""
    return dq.entity_audit(marts.indicators(d), "country_name", AUDIT_ENTITY)


@query("join_row_counts")
def join_row_counts(d: Domain) -> DataFrame:
    """DQ-11: row count after each stage / join of both marts: one pass over the
    monthly features, one over the yearly rollup; no value is joined."""
    in_years = F.col("year").between(*QUERY_YEARS)
    currency = [Step("monthly_with_currency", d.currency_dim, ("partnerISO",), ("country_iso3",))]
    # the account needs the currency behind the first join to follow the second
    monthly = join_accounting(
        marts.with_currency(marts.monthly_features(d), d), "trade_monthly",
        [*currency,
         Step("monthly_with_rates", fxo.fx_monthly(d.fx_raw), ("currency", "year", "month"), ("currency", "year", "month")),
         Step("monthly_mart", where=in_years)])
    indicators = marts.indicators(d)
    yearly = join_accounting(
        marts.with_currency(marts.trade_yearly(d), d), "trade_yearly",
        [Step("yearly_with_currency", d.currency_dim, ("partnerISO",), ("country_iso3",)),
         Step("yearly_with_rates", fxo.fx_yearly(d.fx_raw), ("currency", "year"), ("currency", "year"), in_years),
         Step("yearly_mart", indicators, ("partnerISO", "year"), ("countryISO3", "year"), in_years)])
    return monthly.unionByName(yearly)


@query("profile")
def profile(d: Domain) -> DataFrame:
    """SRC-7 / AGG-13: counts, schema, null shares and sample rows of the inputs."""
    return (dq.profile(d.trade_raw, "trade_raw")
            .unionByName(dq.profile(d.fx_raw, "fx_raw"))
            .unionByName(dq.profile(d.wdi_raw, "wdi_raw")))


@query("trade_bad_periods")
def trade_bad_periods(d: Domain) -> DataFrame:
    """DQ-8: trade rows whose period is no month (annual rows, bad text)."""
    return fxo.unparsable_dates(d.trade_raw.select("data_period", "hs_code", "partner_code"), "data_period", "yyyyMM")


@query("fx_loose_bounds")
def fx_loose_bounds(d: Domain) -> DataFrame:
    """DQ-7 with a margin: currency months whose mean comes within 1.5 of the
    least or greatest rate (a negative tolerance asks for that distance)."""
    return fxo.bounds_violations(fxo.fx_monthly(d.fx_raw), tol=-1.5)


@query("fx_repeated_days")
def fx_repeated_days(d: Domain) -> DataFrame:
    """DQ-11: (currency, date) pairs with several rates, which a join by day
    would multiply."""
    return repeated_keys(d.fx_raw, ["currency", "date"])


# -- features, shares, rollups -----------------------------------------------
@query("trade_month_share")
def trade_month_share(d: Domain) -> DataFrame:
    """WIN-1/2: world total per (period, hs_code) and share of the month."""
    return marts.trade_monthly(d)


@query("fx_monthly")
def fx_monthly(d: Domain) -> DataFrame:
    """PRJ-9 / AGG-2: monthly min / max / mean rate per currency."""
    return fxo.fx_monthly(d.fx_raw)


@query("fx_yearly")
def fx_yearly(d: Domain) -> DataFrame:
    """AGG-3: yearly min / max / mean of daily rates per currency."""
    return fxo.fx_yearly(d.fx_raw)


@query("partner_codes")
def partner_codes(d: Domain) -> DataFrame:
    """PRJ-3/4, J-6: distinct partner code -> alpha-3 pairs."""
    conformed = feat.conform_partner(_cast(d), d.iso_dim)
    return dq.distinct_values(conformed, ["partner_code", "partnerISO"])


@query("indicators_wide")
def indicators_wide(d: Domain) -> DataFrame:
    """PRJ-2, AGG-4, PRJ-5/10/11: wide indicators with alpha-3 and GDP per
    capita."""
    return marts.indicators(d)


@query("indicators_unknown")
def indicators_unknown(d: Domain) -> DataFrame:
    """PRJ-10: indicator names outside a list of two, with their rows."""
    return ind.unknown_indicators(d.wdi_raw, list(LISTED_INDICATORS))


@query("indicators_with_rest")
def indicators_with_rest(d: Domain) -> DataFrame:
    """AGG-4: two listed indicators as columns, all others as (name, value) rows
    from the map that the same pass gives."""
    wide = ind.pivot_with_rest(ind.indicators_typed(d.wdi_raw), list(LISTED_INDICATORS))
    renamed, _ = ind.rename_columns(wide, INDICATOR_NAMES)
    return renamed.select("country_id", "country_name", "year", "population", "gdp",
                          F.explode_outer("other_indicators").alias("other_name", "other_value"))


@query("indicator_renames")
def indicator_renames(d: Domain) -> DataFrame:
    """PRJ-10: which renames apply to the raw pivot of the names that occur."""
    return ind.rename_report(ind.pivot_indicators(ind.indicators_typed(d.wdi_raw), list(LISTED_INDICATORS)), INDICATOR_NAMES)


@query("indicator_growth")
def indicator_growth(d: Domain) -> DataFrame:
    """WIN-5: previous-year GDP and growth % per country."""
    w = marts.indicators(d).select("country_id", "country_name", "year", "gdp")
    return ind.growth(w, "gdp", entity="country_id")


# -- marts -------------------------------------------------------------------
@query("monthly_mart")
def monthly_mart(d: Domain) -> DataFrame:
    """J-1/2, FLT-1: monthly trade + currency + monthly FX, 1996-2000."""
    return marts.monthly_mart(d, QUERY_YEARS)


@query("yearly_currency")
def yearly_currency(d: Domain) -> DataFrame:
    """J-3: yearly trade + currency, all years."""
    return marts.yearly_currency(d)


@query("yearly_mart")
def yearly_mart(d: Domain) -> DataFrame:
    """J-3/4/5, FLT-1: yearly trade + currency + FX + indicators."""
    return marts.yearly_mart(d, QUERY_YEARS)


# -- views and serving rows ----------------------------------------------------
@query("view_trade_time")
def view_trade_time(d: Domain) -> DataFrame:
    """AGG-5 / SRT-2."""
    return vw.trade_time_view(marts.monthly_features(d))


@query("view_commodity_ranking")
def view_commodity_ranking(d: Domain) -> DataFrame:
    """AGG-6 / PRJ-13."""
    return vw.commodity_ranking_view(marts.trade_yearly(d))


@query("view_partner_share")
def view_partner_share(d: Domain) -> DataFrame:
    """AGG-7 / FLT-4."""
    return vw.partner_share_view(marts.trade_yearly(d))


@query("view_economic_structure")
def view_economic_structure(d: Domain) -> DataFrame:
    """AGG-8."""
    return vw.economic_structure_view(marts.yearly_mart(d, QUERY_YEARS))


@query("view_commodity_top10")
def view_commodity_top10(d: Domain) -> DataFrame:
    """SRT-3: the ten largest commodities of the ranking view (a top-k
    report: TakeOrderedAndProject, no global sort)."""
    return vw.top_k(view_commodity_ranking(d), TOP_K, F.desc("total_value_usd"),
                    "commodity_short", "hs_code")


def _tt_cells(d: Domain) -> DataFrame:
    view = vw.trade_time_view(marts.monthly_features(d), ordered=False)
    return srv.to_cells(view, srv.trade_time_key(), "stats", srv.TRADE_TIME_CELLS)


@query("serving_trade_time")
def serving_trade_time(d: Domain) -> DataFrame:
    """PRJ-19 / SNK-3: trade_time cells."""
    return _tt_cells(d)


@query("serving_commodity_ranking")
def serving_commodity_ranking(d: Domain) -> DataFrame:
    """SNK-4: commodity_ranking cells."""
    view = vw.commodity_ranking_view(marts.trade_yearly(d), ordered=False)
    return srv.to_cells(view, srv.commodity_key(), "info", srv.COMMODITY_CELLS)


@query("serving_partner_share")
def serving_partner_share(d: Domain) -> DataFrame:
    """SNK-5: partner_market_share cells."""
    view = vw.partner_share_view(marts.trade_yearly(d), ordered=False)
    return srv.to_cells(view, srv.partner_year_key(), "info", srv.PARTNER_CELLS)


@query("serving_economic_structure")
def serving_economic_structure(d: Domain) -> DataFrame:
    """SNK-6: economic_structure cells."""
    view = vw.economic_structure_view(marts.yearly_mart(d, QUERY_YEARS), ordered=False)
    return srv.to_cells(view, srv.partner_key(), "info", srv.ECONOMIC_CELLS)


@query("serving_commodity_collisions")
def serving_commodity_collisions(d: Domain) -> DataFrame:
    """D10: commodity_ranking row keys produced by more than one view row
    (reported instead of silently overwritten)."""
    view = vw.commodity_ranking_view(marts.trade_yearly(d), ordered=False)
    return key_collisions(view.select(srv.commodity_key().alias("row_key")), "row_key")


@query("serving_commodity_collisions_short")
def serving_commodity_collisions_short(d: Domain) -> DataFrame:
    """D10: the view rows behind colliding keys when names are cut to one
    letter: each row with its key and the number of rows that share it."""
    view = vw.commodity_ranking_view(marts.trade_yearly(d), ordered=False)
    keyed = view.select(srv.commodity_key(width=1).alias("row_key"), "commodity_short", "hs_code", "total_value_usd")
    return srv.colliding_rows(keyed)


@query("trade_yearly_excl_world")
def trade_yearly_excl_world(d: Domain) -> DataFrame:
    """D3 option: yearly shares with the world aggregate removed before the
    denominators."""
    return marts.trade_yearly(d, exclude_partners=("W00",))


@query("serving_peek")
def serving_peek(d: Domain) -> DataFrame:
    """SRC-6: first five row keys of trade_time with their cells."""
    return srv.peek(_tt_cells(d), PEEK_K)


def _lake(d: Domain, name: str) -> LakePaths:
    return LakePaths(scratch_path(d.spark, name))


@query("lake_trade_read_back")
def lake_trade_read_back(d: Domain) -> DataFrame:
    """SRC-1, SNK-1, SNK-7, FLT-1: trade records written to their zone as text,
    read with the typed reader, a range of periods pushed to the files."""
    lake = _lake(d, "lake-trade")
    text = d.trade_raw.select(*[F.col(c).cast("string").alias(c) for c in d.trade_raw.columns])
    write_table(text, lake.trade)
    return period_range(read_trade(d.spark, lake.trade), *QUERY_YEARS)


@query("lake_rates_read_back")
def lake_rates_read_back(d: Domain) -> DataFrame:
    """SRC-2, SNK-1: daily rates written and read with the typed reader."""
    lake = _lake(d, "lake-rates")
    write_table(d.fx_raw, lake.rates)
    return read_fx(d.spark, lake.rates)


@query("lake_indicators_read_back")
def lake_indicators_read_back(d: Domain) -> DataFrame:
    """SRC-3, SNK-7: indicators written as one folder per indicator, read by glob."""
    lake = _lake(d, "lake-indicators")
    for i, name in enumerate(INDICATOR_NAMES):
        write_table(d.wdi_raw.filter(F.col("indicator_name") == name), f"{lake.indicators}/set{i}.parquet")
    return read_indicators(d.spark, f"{lake.indicators}/set*.parquet")


@query("lake_dimension_read_back")
def lake_dimension_read_back(d: Domain) -> DataFrame:
    """SRC-4, SNK-2: the code dimension written and loaded as a code table."""
    lake = _lake(d, "lake-dim")
    write_dimension(d.iso_dim, f"{lake.dims}/iso")
    return read_code_table(d.spark, f"{lake.dims}/iso")


@query("lake_mart_series")
def lake_mart_series(d: Domain) -> DataFrame:
    """SRC-5, SNK-1, SER-1: the monthly mart written by year, read for its years,
    and charted."""
    lake = _lake(d, "lake-mart")
    write_table(marts.monthly_mart(d, None, with_shares=False), lake.table("monthly"), ["year"])
    return ser.partner_fx_series(read_mart(d.spark, lake.table("monthly"), QUERY_YEARS), SERIES_PARTNER, SERIES_CURRENCY)


@query("published_partner_share")
def published_partner_share(d: Domain) -> DataFrame:
    """SNK-5: the partner view published (staged, gated, switched) and read back
    as cells."""
    view = vw.partner_share_view(marts.trade_yearly(d), ordered=False)
    table = srv.PublishedTable(d.spark, _lake(d, "published").serving("partner_market_share"))
    table.publish(srv.to_serving(view, srv.partner_year_key(), "info", srv.PARTNER_CELLS))
    return table.read().select("row_key", F.explode("cells").alias("column", "value"))


# -- series ------------------------------------------------------------------
def _mart_trade_rows(d: Domain) -> DataFrame:
    """The monthly mart's trade rows (its currency / FX joins are left joins
    on unique keys, so the rows are the year-filtered monthly features)."""
    return marts.monthly_features(d, QUERY_YEARS)


@query("series_partner_fx")
def series_partner_fx(d: Domain) -> DataFrame:
    """SER-1 / PRJ-15: one partner's monthly rows with the FX mean."""
    mart = marts.monthly_mart(d, QUERY_YEARS, with_shares=False)
    return ser.partner_fx_series(mart, SERIES_PARTNER, SERIES_CURRENCY)


@query("series_partner_fx_monthly")
def series_partner_fx_monthly(d: Domain) -> DataFrame:
    """SER-1, summed variant: one point per month for the partner."""
    mart = marts.monthly_mart(d, QUERY_YEARS, with_shares=False)
    return ser.partner_fx_monthly(mart, SERIES_PARTNER, SERIES_CURRENCY)


@query("view_trade_time_weighted")
def view_trade_time_weighted(d: Domain) -> DataFrame:
    """D7 variant: value-weighted unit price per (year, month)."""
    return vw.trade_time_view(marts.monthly_features(d), weighted=True)


@query("series_country_year")
def series_country_year(d: Domain) -> DataFrame:
    """SER-2 / FLT-2 / PRJ-18: GDP per capita and value for a country list."""
    return ser.country_year_series(marts.yearly_mart(d, QUERY_YEARS), list(SERIES_COUNTRIES))


@query("series_commodity_dense")
def series_commodity_dense(d: Domain) -> DataFrame:
    """SER-3 / AGG-9/14 / PRJ-14: dense commodity x month grid."""
    return ser.dense_grid(ser.commodity_month_values(_mart_trade_rows(d)), "commodity", "date", "value")


@query("series_axis")
def series_axis(d: Domain) -> DataFrame:
    """AGG-14: the ordered dates of the grid."""
    return ser.axis_points(ser.commodity_month_values(_mart_trade_rows(d)), "date")


@query("series_month_total")
def series_month_total(d: Domain) -> DataFrame:
    """AGG-10: total per month."""
    return ser.month_totals(_mart_trade_rows(d))


def _partner_map(d: Domain) -> DataFrame:
    t = ser.partner_totals(_mart_trade_rows(d), SERIES_YEAR)
    return t.withColumn("log_export", F.round("log_export", 9))


@query("series_map")
def series_map(d: Domain) -> DataFrame:
    """SER-4 / AGG-11 / PRJ-16: partner totals for one year, log scale."""
    return _partner_map(d)


@query("series_top_partner")
def series_top_partner(d: Domain) -> DataFrame:
    """AGG-12: partner with the largest total."""
    return ser.top_partner(_partner_map(d))


@query("series_axis_ticks")
def series_axis_ticks(d: Domain) -> DataFrame:
    """PRJ-17: six log-scale ticks with dollar labels."""
    return ser.axis_ticks(_partner_map(d), 6)


from portolan.plans import streams  # noqa: E402,F401  (registers the streaming queries)
