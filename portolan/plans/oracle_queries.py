"""DuckDB statements for the registered queries (see ``oracle.py``)."""

from __future__ import annotations

from portolan.plans.oracle import Y0, Y1, fmean, fsum, fsum_over, ratio, register, round_half_up
from portolan.plans.params import (
    AUDIT_ENTITY,
    LISTED_INDICATORS,
    PEEK_K,
    SERIES_COUNTRIES,
    SERIES_CURRENCY,
    SERIES_PARTNER,
    SERIES_YEAR,
    TOP_K,
)
from portolan.schemas import INDICATOR_NAMES

# -- data quality ------------------------------------------------------------
register("trade_features", "select * from trade_features")

register("trade_missing_report", """
select count(case when data_period is null or trim(data_period) = '' then 1 end) as data_period,
       count(case when hs_code is null or trim(hs_code) = '' then 1 end) as hs_code,
       count(case when commodity_desc is null or trim(commodity_desc) = '' then 1 end) as commodity_desc,
       count(case when partner_code is null or trim(partner_code) = '' then 1 end) as partner_code,
       count(case when quantity is null or isnan(quantity) then 1 end) as quantity,
       count(case when weight is null or isnan(weight) then 1 end) as weight,
       count(case when primary_value_usd is null or isnan(primary_value_usd) then 1 end) as primary_value_usd,
       count(*) as total_rows
from trade_cast""")

register("trade_fill", """
select data_period, hs_code, commodity_desc, partner_code,
       case when quantity is null or isnan(quantity) then 0.0 else quantity end as quantity,
       case when weight is null or isnan(weight) then 0.0 else weight end as weight,
       primary_value_usd
from trade_cast""")

def _stats(col: str) -> str:
    return (f"select '{col}' as column_name, count({col}) as n, {fmean(col, 2)} as mean, "
            f"cast(min({col}) as double) as min, cast(max({col}) as double) as max from filled")


register("trade_stats", "\nunion all\n".join(_stats(c) for c in ("quantity", "weight", "primary_value_usd")),
         """filled as (
  select case when quantity is null or isnan(quantity) then 0.0 else quantity end as quantity,
         case when weight is null or isnan(weight) then 0.0 else weight end as weight,
         primary_value_usd
  from trade_cast)""")

def _summary(col: str) -> str:
    quantiles = ", ".join(f"quantile_disc({col}, {p}) as q{int(100 * p)}" for p in (0.25, 0.5, 0.75))
    return (f"select '{col}' as column_name, count({col}) as n, {round_half_up(fmean(col, 2), 4)} as mean, "
            f"{round_half_up(f'stddev_samp({col})', 4)} as stddev, min({col}) as min, {quantiles}, "
            f"max({col}) as max from filled")


register("trade_summary", "\nunion all\n".join(_summary(c) for c in ("quantity", "weight", "primary_value_usd")),
         """filled as (
  select case when quantity is null or isnan(quantity) then 0.0 else quantity end as quantity,
         case when weight is null or isnan(weight) then 0.0 else weight end as weight,
         primary_value_usd
  from trade_cast)""")

register("distinct_periods", """
select distinct data_period, year, month, quarter, quarter_label from trade_features""")

register("year_range", """
select min(year) as min_year, max(year) as max_year, count(year) as non_null,
       count(case when year is null then 1 end) as nulls
from trade_features""")

register("fx_bounds_violations", """
select * from fx_yearly
where avg_rate < min_rate - 1e-9 or avg_rate > max_rate + 1e-9""")

register("fx_bad_dates", """
select * from fx_raw where try_strptime(date, '%Y-%m-%d') is null""")

register("world_reconciliation", f"""
select year,
       {fsum("case when \"partnerISO\" = 'W00' then annual_value_usd end")} as world_reported,
       {fsum("case when \"partnerISO\" is null or \"partnerISO\" <> 'W00' then annual_value_usd end")}
           as partners_total,
       {fsum("case when \"partnerISO\" = 'W00' then annual_value_usd end")}
         - {fsum("case when \"partnerISO\" is null or \"partnerISO\" <> 'W00' then annual_value_usd end")}
           as difference
from trade_yearly group by year""")

register("entity_audit", f"""
select w.*, s.n_rows, s.min_year, s.max_year
from indicators_wide w
join (select country_name, count(*) as n_rows, min(year) as min_year, max(year) as max_year
      from indicators_wide where country_name = '{AUDIT_ENTITY}' group by country_name) s
  on w.country_name = s.country_name""")

register("join_row_counts", """
select 'trade_monthly' as stage, count(*) as row_count from trade_monthly
union all select 'monthly_with_currency', count(*) from trade_monthly_currency
union all select 'monthly_with_rates', count(*) from trade_monthly_currency m
  left join fx_monthly f on m.currency = f.currency and m.year = f.year and m.month = f.month
union all select 'monthly_mart', count(*) from monthly_mart
union all select 'trade_yearly', count(*) from trade_yearly
union all select 'yearly_with_currency', count(*) from yearly_currency
union all select 'yearly_with_rates', count(*) from yearly_rates
union all select 'yearly_mart', count(*) from yearly_mart""")

_TYPES = {"trade_raw": {"data_period": "string", "hs_code": "string", "commodity_desc": "string",
                        "partner_code": "string", "quantity": "double", "weight": "double",
                        "primary_value_usd": "double"},
          "fx_raw": {"currency": "string", "date": "string", "rate": "double"},
          "wdi_raw": {c: "string" for c in ("country_id", "country_name", "year", "indicator_name", "value")}}


def _profile(table: str) -> str:
    kinds = _TYPES[table]
    text = ", ".join(f"coalesce(cast(try_cast({c} as decimal(38,6)) as varchar), '\\N')" if k == "double"
                     else f"coalesce({c}, '\\N')" for c, k in kinds.items())
    parts = [f"select 'rows' as section, 'all' as item, cast(count(*) as varchar) as value from {table}",
             f"select 'columns', 'all', '{len(kinds)}'", f"select 'first_columns', 'all', '{','.join(kinds)}'"]
    parts += [f"select 'schema', '{c}', '{k}'" for c, k in kinds.items()]
    for c, k in kinds.items():
        test = f"isnan({c})" if k == "double" else f"trim({c}) = ''"
        parts.append(f"select 'null_share', '{c}', cast(cast(round(count(case when {c} is null or {test} then 1 end) "
                     f"/ count(*), 6) as decimal(38,6)) as varchar) from {table}")
    parts.append(f"select 'sample', cast(row_number() over (order by md5(t), t) as varchar), t from "
                 f"(select concat_ws(chr(31), {text}) as t from {table} order by md5(t), t limit 5)")
    return f"select '{table}' as table_name, section, item, value from (" + "\nunion all\n".join(parts) + ")"


register("profile", "\nunion all\n".join(_profile(t) for t in _TYPES))

register("trade_bad_periods", """
select data_period, hs_code, partner_code from trade_raw where try_strptime(data_period, '%Y%m') is null""")

register("fx_loose_bounds", """
select * from fx_monthly where avg_rate < min_rate + 1.5 or avg_rate > max_rate - 1.5""")

register("fx_repeated_days", """
select currency, date, count(*) as n from fx_raw where currency is not null and date is not null
group by currency, date having count(*) > 1""")

register("indicators_unknown", f"""
select indicator_name, count(*) as n_rows from wdi_raw
where indicator_name is null or indicator_name not in {LISTED_INDICATORS!r} group by indicator_name""")

register("indicators_with_rest", f"""
select k.country_id, k.country_name, k.year, population, gdp, other_name, other_value
from (select country_id, country_name, year,
             max(case when indicator_name = 'Population, total' then value end) as population,
             max(case when indicator_name = 'GDP (current US$)' then value end) as gdp
      from wdi_typed group by country_id, country_name, year) k
left join (select country_id, country_name, year, indicator_name as other_name, max(value) as other_value
           from wdi_typed where indicator_name not in {LISTED_INDICATORS!r}
           group by country_id, country_name, year, indicator_name) o
  on k.country_id is not distinct from o.country_id and k.country_name is not distinct from o.country_name
     and k.year is not distinct from o.year""")

register("indicator_renames", "\nunion all\n".join(
    f"select '{k}' as source_name, '{v}' as target_name, "
    f"exists (select 1 from wdi_raw where indicator_name = '{k}') and '{k}' in {LISTED_INDICATORS!r} as present"
    for k, v in INDICATOR_NAMES.items()))

# -- features, shares, rollups -----------------------------------------------
register("trade_yearly", "select * from trade_yearly")
register("trade_month_share", "select * from trade_monthly")
register("fx_monthly", "select * from fx_monthly")
register("fx_yearly", "select * from fx_yearly")
register("partner_codes", 'select distinct partner_code, "partnerISO" from trade_conformed')
register("indicators_wide", "select * from indicators_wide")

register("indicator_growth", f"""
select country_id, country_name, year, gdp, prev_gdp,
       {round_half_up('(gdp - prev_gdp) / prev_gdp * 100.0', 2)} as gdp_growth
from (select country_id, country_name, year, gdp,
             lag(gdp) over (partition by country_id order by year) as prev_gdp
      from indicators_wide)""")

# -- marts -------------------------------------------------------------------
register("monthly_mart", "select * from monthly_mart")
register("yearly_currency", "select * from yearly_currency")
register("yearly_mart", "select * from yearly_mart")

# -- views -------------------------------------------------------------------
VIEW_TRADE_TIME = f"""
view_trade_time as (
  select year, month, {fsum('primary_value_usd')} as total_value_usd,
         {fsum('quantity')} as total_quantity,
         round(avg(unit_value_usd), 6) as avg_unit_price
  from trade_features group by year, month)"""

VIEW_COMMODITY = f"""
view_commodity_ranking as (
  select split_part(commodity_desc, ';', 1) as commodity_short, hs_code,
         {fsum('annual_value_usd')} as total_value_usd,
         {fsum('quantity')} as total_quantity,
         round(avg(unit_value_usd), 6) as avg_unit_price
  from trade_yearly group by split_part(commodity_desc, ';', 1), hs_code)"""

VIEW_PARTNER = f"""
view_partner_share as (
  select "partnerISO", year, {fsum('annual_value_usd')} as partner_value_usd,
         round(avg(share_of_year_market), 10) as avg_market_share
  from trade_yearly where "partnerISO" <> 'W00' group by "partnerISO", year)"""

VIEW_ECONOMIC = f"""
view_economic_structure as (
  select "partnerISO", round(avg(industry_in_gdp), 8) as industry_share,
         round(avg(services_in_gdp), 8) as services_share,
         round(avg(trade_in_gdp), 8) as trade_share,
         {fsum('annual_value_usd')} as trade_value
  from yearly_mart group by "partnerISO")"""

register("view_trade_time", "select * from view_trade_time", VIEW_TRADE_TIME)
register("view_commodity_ranking", "select * from view_commodity_ranking", VIEW_COMMODITY)
register("view_partner_share", "select * from view_partner_share", VIEW_PARTNER)
register("view_economic_structure", "select * from view_economic_structure", VIEW_ECONOMIC)
register("view_commodity_top10", f"""
select * from view_commodity_ranking
order by total_value_usd desc, commodity_short asc nulls first, hs_code asc nulls first
limit {TOP_K}""", VIEW_COMMODITY)


# -- serving rows (long form: row_key, column, value) -------------------------
def _text(col: str, scale: int | None) -> str:
    if scale is None:
        return f"cast({col} as varchar)"
    return f"cast(try_cast({col} as decimal(38,{scale})) as varchar)"


def _cells(view: str, key: str, family: str, cells: list[tuple[str, str, int | None]]) -> str:
    parts = [f"select {key} as row_key, '{family}:{q}' as \"column\", {_text(c, s)} as value from {view}"
             for q, c, s in cells]
    return "select * from (" + "\nunion all\n".join(parts) + ") where value is not null"


def _present(col: str, numeric: bool = False) -> str:
    return f"({col} is not null and {col} <> {'0' if numeric else chr(39) * 2})"


TT_KEY = "concat_ws('_', cast(year as varchar), cast(month as varchar))"
TT_CELLS = [("year", "year", None), ("month", "month", None),
            ("total_value_usd", "total_value_usd", 2), ("total_quantity", "total_quantity", 2),
            ("avg_unit_price", "avg_unit_price", 6)]
CR_KEY = (f"concat(case when {_present('hs_code')} then hs_code else 'UNKNOWN' end, '_', "
          f"case when {_present('commodity_short')} then substr(replace(regexp_replace("
          f"commodity_short, '^\\s+|\\s+$', '', 'g'), ' ', '_'), 1, 20) else 'NO_NAME' end)")
CR_CELLS = [("commodity_name", "commodity_short", None), ("hs_code", "hs_code", None),
            ("total_value_usd", "total_value_usd", 2), ("total_quantity", "total_quantity", 2),
            ("avg_unit_price", "avg_unit_price", 6)]
PS_KEY = (f"concat(case when {_present(chr(34) + 'partnerISO' + chr(34))} then \"partnerISO\" "
          f"else 'UNKNOWN' end, '_', case when {_present('year', True)} then cast(year as varchar) "
          f"else '0000' end)")
PS_CELLS = [("partner_iso", '"partnerISO"', None), ("year", "year", None),
            ("partner_value_usd", "partner_value_usd", 2), ("avg_market_share", "avg_market_share", 10)]
ES_KEY = f"case when {_present(chr(34) + 'partnerISO' + chr(34))} then \"partnerISO\" else 'UNKNOWN' end"
ES_CELLS = [("partner_iso", '"partnerISO"', None), ("industry_share", "industry_share", 8),
            ("services_share", "services_share", 8), ("trade_share", "trade_share", 8),
            ("trade_value", "trade_value", 2)]

register("serving_trade_time", _cells("view_trade_time", TT_KEY, "stats", TT_CELLS), VIEW_TRADE_TIME)
register("serving_commodity_ranking", _cells("view_commodity_ranking", CR_KEY, "info", CR_CELLS),
         VIEW_COMMODITY)
register("serving_partner_share", _cells("view_partner_share", PS_KEY, "info", PS_CELLS), VIEW_PARTNER)
register("serving_economic_structure", _cells("view_economic_structure", ES_KEY, "info", ES_CELLS),
         VIEW_ECONOMIC)
register("serving_commodity_collisions", f"""
select row_key, count(*) as n from (select {CR_KEY} as row_key from view_commodity_ranking)
group by row_key having count(*) > 1""", VIEW_COMMODITY)

register("serving_commodity_collisions_short", f"""
select * from (
  select {CR_KEY.replace(", 1, 20)", ", 1, 1)")} as row_key, commodity_short, hs_code, total_value_usd,
         count(*) over (partition by row_key) as n
  from view_commodity_ranking) where n > 1""", VIEW_COMMODITY)

register("serving_peek", f"""
select * from tt_cells
where row_key in (select distinct row_key from tt_cells order by row_key limit {PEEK_K})""",
         VIEW_TRADE_TIME + ",\ntt_cells as (" + _cells("view_trade_time", TT_KEY, "stats", TT_CELLS) + ")")

register("published_partner_share", _cells("view_partner_share", PS_KEY, "info", PS_CELLS), VIEW_PARTNER)

# -- written and read back ------------------------------------------------------
register("lake_trade_read_back", f"""
select data_period, hs_code, commodity_desc, partner_code, quantity, weight, primary_value_usd
from trade_cast where try_cast(substr(data_period, 1, 4) as integer) between {Y0} and {Y1}""")
register("lake_rates_read_back", "select currency, date, rate from fx_raw")
register("lake_indicators_read_back", "select country_id, country_name, year, indicator_name, value from wdi_typed")
register("lake_dimension_read_back", "select iso_numeric, iso2, iso3 from iso_dim")
register("lake_mart_series", f"""
select printf('%d-%02d', year, month) as month_label, year, month, commodity_desc,
       cast(primary_value_usd as double) as value, avg_rate
from monthly_mart where "partnerISO" = '{SERIES_PARTNER}' and currency = '{SERIES_CURRENCY}'""")

# -- series ------------------------------------------------------------------

register("series_partner_fx", f"""
select printf('%d-%02d', year, month) as month_label, year, month, commodity_desc,
       cast(primary_value_usd as double) as value, avg_rate
from monthly_mart where "partnerISO" = '{SERIES_PARTNER}' and currency = '{SERIES_CURRENCY}'""")

register("series_country_year", f"""
select country_name, cast(year as double) as year, cast(gdp_per_capita as double) as gdp_per_capita,
       cast(annual_value_usd as double) as import_value, commodity_desc
from yearly_mart where country_name in {SERIES_COUNTRIES!r}""")

COMMODITY_MONTH = f"""
cm as (
  select split_part(commodity_desc, ';', 1) as commodity, make_date(year, month, 1) as date,
         {fsum('primary_value_usd')} as value
  from monthly_mart where "partnerISO" <> 'W00'
  group by split_part(commodity_desc, ';', 1), make_date(year, month, 1))"""

register("series_commodity_dense", """
select c.commodity, d.date, coalesce(cm.value, 0.0) as value
from (select distinct commodity from cm) c
cross join (select distinct date from cm where date is not null) d
left join cm on cm.commodity is not distinct from c.commodity and cm.date = d.date""",
         COMMODITY_MONTH)

register("series_axis", "select distinct date from cm where date is not null", COMMODITY_MONTH)

register("series_month_total", f"""
select make_date(year, month, 1) as date, {fsum('primary_value_usd')} as total_value
from monthly_mart where "partnerISO" <> 'W00' group by make_date(year, month, 1)""")

PARTNER_MAP = f"""
pm as (
  select "partnerISO", export, round(log10(export + 1.0), 9) as log_export
  from (select "partnerISO", {fsum('primary_value_usd')} as export
        from monthly_mart where year = {SERIES_YEAR} group by "partnerISO")
  where "partnerISO" <> 'W00')"""

register("series_map", "select * from pm", PARTNER_MAP)
register("series_top_partner", """
select "partnerISO" as top_partner, export as top_export from pm
order by export desc, "partnerISO" desc limit 1""", PARTNER_MAP)
register("series_axis_ticks", """
select cast(i as integer) as i, round(v, 9) as tick, '$' || format('{:,}', cast(trunc(pow(10.0, v) - 1.0) as bigint)) as label
from (select i, case when i = 5 then hi else lo + i * ((hi - lo) / 5.0) end as v
      from (select min(log_export) as lo, max(log_export) as hi from pm),
           (select unnest(range(0, 6)) as i))""", PARTNER_MAP)

# -- streaming (batch equivalents) ----------------------------------------------
register("rates_weekly_stream", f"""
select event_type as currency, cast(date_trunc('week', ts) as date) as week_start,
       cast(date_trunc('week', ts) + interval 7 day as date) as week_end,
       min(value) as min_rate, max(value) as max_rate, {fmean('value', 8)} as avg_rate,
       count(*) as n_rates
from events group by event_type, date_trunc('week', ts)""")

register("rates_weekly_account_stream", """
select count(*) as rows_in, count(*) as rows_in_table, cast(0 as bigint) as rows_late from events""")

register("events_outcomes_stream", """
select case when props is null or (json_valid(props) and json_type(props) = 'OBJECT') then 'landed'
            else 'broken_json' end as outcome, count(*) as n_rows
from events group by 1""")

register("rates_monthly_stream", f"""
select event_type as currency, cast(date_trunc('month', ts) as date) as month_start,
       min(value) as min_rate, max(value) as max_rate, {fmean('value', 8)} as avg_rate,
       count(*) as n_rates
from events group by event_type, date_trunc('month', ts)""")

register("events_landed_stream", """
select event_id, ts, user_id, event_type, value, props,
       cast(json_extract(props, '$.k') as integer) as k
from events""")

register("trade_enriched_stream", """
select f.*, c.currency from trade_features f
left join currency_dim c on f."partnerISO" = c.country_iso3""")

register("trade_totals_stream", f"""
select data_period, hs_code, {fsum('primary_value_usd')} as month_world_export_value
from trade_features group by data_period, hs_code""")

# -- options -------------------------------------------------------------------
register("trade_yearly_excl_world", f"""
select *, {ratio('annual_value_usd', 'world_export_value')} as share_of_year_market
from (select y.*,
             {ratio('annual_value_usd', 'quantity')} as unit_value_usd,
             {ratio('annual_value_usd', 'weight')} as usd_per_kg,
             {fsum_over('annual_value_usd', 'year, hs_code')} as world_export_value
      from (select year, "partnerISO", commodity_desc, hs_code,
                   {fsum('primary_value_usd')} as annual_value_usd,
                   {fsum('quantity')} as quantity, {fsum('weight')} as weight
            from trade_features where "partnerISO" <> 'W00' or "partnerISO" is null
            group by year, "partnerISO", commodity_desc, hs_code) y)""")

register("series_partner_fx_monthly", f"""
select year, month, {fsum('primary_value_usd')} as value, max(avg_rate) as avg_rate,
       printf('%d-%02d', year, month) as month_label
from monthly_mart where "partnerISO" = '{SERIES_PARTNER}' and currency = '{SERIES_CURRENCY}'
group by year, month""")

register("view_trade_time_weighted", f"""
select year, month, total_value_usd, total_quantity,
       round({ratio('total_value_usd', 'total_quantity')}, 6) as avg_unit_price
from (select year, month, {fsum('primary_value_usd')} as total_value_usd,
             {fsum('quantity')} as total_quantity
      from trade_features group by year, month)""")

RATE_WEEKLY = f"""
rw as (
  select event_type as currency, cast(date_trunc('week', ts) as date) as week_start,
         min(value) as min_rate, max(value) as max_rate, {fmean('value', 8)} as avg_rate,
         count(*) as n_rates
  from events group by event_type, date_trunc('week', ts))"""
RATE_MONTHLY = f"""
rm as (
  select event_type as currency, cast(date_trunc('month', ts) as date) as month_start,
         min(value) as min_rate, max(value) as max_rate, {fmean('value', 8)} as avg_rate,
         count(*) as n_rates
  from events group by event_type, date_trunc('month', ts))"""
RATE_CELLS = [("min_rate", "min_rate", 8), ("max_rate", "max_rate", 8),
              ("avg_rate", "avg_rate", 8), ("n_rates", "n_rates", None)]
register("serving_rates_weekly", _cells(
    "rw", f"concat(case when {_present('currency')} then currency else 'UNKNOWN' end, '_', "
          "cast(week_start as varchar))", "rates", RATE_CELLS), RATE_WEEKLY)
register("serving_rates_monthly", _cells(
    "rm", f"concat(case when {_present('currency')} then currency else 'UNKNOWN' end, '_', "
          "strftime(month_start, '%Y-%m'))", "rates", RATE_CELLS), RATE_MONTHLY)
