"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement starts from the driver tables and re-derives the domain
tables with the same expressions as ``portolan.sources.adapter``; only the
CTEs a statement references are evaluated.

Exactness conventions shared with the Spark side:
* money / quantity sums: ``fixed_sum`` -- long units of 10^-2, then / 100;
* rate means: ``fixed_mean`` at 10^-8;
* means of ratios (unit prices, shares, indicator percentages) are rounded
  to 6 decimals in the views;
* ``round(x, 2)`` of a double is compared through ``decimal(38,10)``,
  which is HALF_UP on the decimal value as Spark's ``round`` is.
"""

from __future__ import annotations

from portolan.plans.params import QUERY_YEARS

Y0, Y1 = QUERY_YEARS


def fsum(expr: str, scale: int = 2) -> str:
    return (f"(cast(sum(cast(floor(({expr}) * {float(10 ** scale)!r} + 0.5) as bigint)) as double)"
            f" / {float(10 ** scale)!r})")


def fsum_over(expr: str, partition: str, scale: int = 2) -> str:
    return (f"(cast(sum(cast(floor(({expr}) * {float(10 ** scale)!r} + 0.5) as bigint)) "
            f"over (partition by {partition}) as double) / {float(10 ** scale)!r})")


def fmean(expr: str, scale: int) -> str:
    u = f"cast(floor(({expr}) * {float(10 ** scale)!r} + 0.5) as bigint)"
    return f"((cast(sum({u}) as double) / {float(10 ** scale)!r}) / cast(count({u}) as double))"


def ratio(num: str, den: str) -> str:
    return f"(case when {den} > 0 then {num} / {den} else 0.0 end)"


def round_half_up(expr: str, digits: int) -> str:
    return f"cast(round(cast({expr} as decimal(38,10)), {digits}) as double)"


def r6(expr: str) -> str:
    return round_half_up(expr, 6)


CTES = f"""
trade_raw as (
  select cast(case when l.l_orderkey % 50 = 0 then year(l.l_shipdate)
                   else year(l.l_shipdate) * 100 + month(l.l_shipdate) end as varchar) as data_period,
         p.p_brand as hs_code,
         concat(p.p_type, '; ', p.p_brand) as commodity_desc,
         cast(nullif(c.c_nationkey, 24) as varchar) as partner_code,
         case when l.l_partkey % 11 = 0 then null else l.l_quantity end as quantity,
         case when l.l_partkey % 13 = 0 then 0.0 else l.l_quantity * p.p_size end as weight,
         l.l_extendedprice as primary_value_usd
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey
  join part p on l.l_partkey = p.p_partkey
),
iso_dim as (
  select n_nationkey as iso_numeric,
         concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1), 'X') as iso2,
         case when n_nationkey = 23 then 'W00'
              else concat('N', lpad(cast(n_nationkey as varchar), 2, '0')) end as iso3
  from nation where n_nationkey <> 0
),
currency_dim as (
  select iso3 as country_iso3, nullif(cast(iso_numeric % 6 as varchar), '0') as currency
  from iso_dim
),
fx_raw as (
  select substr(o_orderpriority, 1, 1) as currency,
         substr(cast(o_orderdate as varchar), 1, 10) as date,
         o_totalprice / 100000.0 as rate
  from orders
),
wdi_agg as (
  select n.n_nationkey as nk, n.n_name as country_name, year(o.o_orderdate) as yr,
         count(distinct o.o_custkey) as pop,
         sum(cast(o.o_totalprice as decimal(18,2))) as gdp,
         count(*) as cnt
  from orders o join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  group by n.n_nationkey, n.n_name, year(o.o_orderdate)
),
wdi_raw as (
  select concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXY', nk + 1, 1), 'X') as country_id, country_name,
         cast(yr as varchar) as year, 'Population, total' as indicator_name,
         cast(pop as varchar) as value from wdi_agg
  union all
  select concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXY', nk + 1, 1), 'X'), country_name,
         cast(yr as varchar), 'GDP (current US$)', cast(gdp as varchar) from wdi_agg
  union all
  select concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXY', nk + 1, 1), 'X'), country_name,
         cast(yr as varchar), 'Services, value added (% of GDP)', cast(cnt % 60 as varchar)
  from wdi_agg where nk % 5 <> 1
),
trade_cast as (
  select data_period, hs_code, commodity_desc, partner_code,
         try_cast(quantity as double) as quantity, try_cast(weight as double) as weight,
         try_cast(primary_value_usd as double) as primary_value_usd
  from trade_raw
),
trade_conformed as (
  select t.*,
         case when coalesce(i.iso3, 'UNIDENTIFIED') in ('X1', '_X', 'E19', 'F19') then 'UNIDENTIFIED'
              else coalesce(i.iso3, 'UNIDENTIFIED') end as "partnerISO"
  from trade_cast t left join iso_dim i on try_cast(trim(t.partner_code) as integer) = i.iso_numeric
),
trade_filled as (
  select data_period, hs_code, commodity_desc, partner_code,
         case when quantity is null or isnan(quantity) then 0.0 else quantity end as quantity,
         case when weight is null or isnan(weight) then 0.0 else weight end as weight,
         primary_value_usd, "partnerISO"
  from trade_conformed
),
trade_features as (
  select *, cast(ceil(month / 3) as integer) as quarter,
         'Q' || cast(cast(ceil(month / 3) as integer) as varchar) as quarter_label
  from (
    select f.*,
           {ratio('primary_value_usd', 'quantity')} as unit_value_usd,
           {ratio('primary_value_usd', 'weight')} as usd_per_kg,
           try_cast(substr(data_period, 1, 4) as integer) as year,
           case when length(data_period) = 6 then try_cast(substr(data_period, 5, 2) as integer)
                else 1 end as month
    from trade_filled f)
),
trade_monthly as (
  select *, {ratio('primary_value_usd', 'month_world_export_value')} as share_of_month_market
  from (select *, {fsum_over('primary_value_usd', 'data_period, hs_code')}
                  as month_world_export_value
        from trade_features)
),
yearly_base as (
  select year, "partnerISO", commodity_desc, hs_code,
         {fsum('primary_value_usd')} as annual_value_usd,
         {fsum('quantity')} as quantity,
         {fsum('weight')} as weight
  from trade_features group by year, "partnerISO", commodity_desc, hs_code
),
trade_yearly as (
  select *, {ratio('annual_value_usd', 'world_export_value')} as share_of_year_market
  from (select y.*,
               {ratio('annual_value_usd', 'quantity')} as unit_value_usd,
               {ratio('annual_value_usd', 'weight')} as usd_per_kg,
               {fsum_over('annual_value_usd', 'year, hs_code')} as world_export_value
        from yearly_base y)
),
fx_parsed as (
  select currency, try_strptime(date, '%Y-%m-%d')::date as date, rate from fx_raw
),
fx_monthly as (
  select currency, year(date) as year, month(date) as month,
         min(rate) as min_rate, max(rate) as max_rate, {fmean('rate', 8)} as avg_rate
  from fx_parsed group by currency, year(date), month(date)
),
fx_yearly as (
  select currency, year(date) as year,
         min(rate) as min_rate, max(rate) as max_rate, {fmean('rate', 8)} as avg_rate
  from fx_parsed group by currency, year(date)
),
wdi_typed as (
  select country_id, country_name, try_cast(year as integer) as year, indicator_name,
         try_cast(value as double) as value
  from wdi_raw
),
wdi_pivot as (
  select country_id, country_name, year,
    max(case when indicator_name = 'External debt stocks, total (DOD, current US$)' then value end) as external_debt,
    max(case when indicator_name = 'GDP (current US$)' then value end) as gdp,
    max(case when indicator_name = 'Imports of goods and services (current US$)' then value end) as import,
    max(case when indicator_name = 'Industry (including construction), value added (% of GDP)' then value end) as industry_in_gdp,
    max(case when indicator_name = 'Inflation, consumer prices (annual %)' then value end) as inflation,
    max(case when indicator_name = 'Population, total' then value end) as population,
    max(case when indicator_name = 'Services, value added (% of GDP)' then value end) as services_in_gdp,
    max(case when indicator_name = 'Trade (% of GDP)' then value end) as trade_in_gdp
  from wdi_typed group by country_id, country_name, year
),
indicators_wide as (
  select p.*, i.iso3 as "countryISO3",
         {round_half_up('p.gdp / nullif(p.population, 0)', 2)} as gdp_per_capita
  from wdi_pivot p left join iso_dim i on p.country_id = i.iso2
),
trade_monthly_currency as (
  select m.*, c.currency from trade_monthly m
  left join currency_dim c on m."partnerISO" = c.country_iso3
),
monthly_mart as (
  select m.*, f.min_rate, f.max_rate, f.avg_rate
  from trade_monthly_currency m
  left join fx_monthly f on m.currency = f.currency and m.year = f.year and m.month = f.month
  where m.year between {Y0} and {Y1}
),
yearly_currency as (
  select y.*, c.currency from trade_yearly y
  left join currency_dim c on y."partnerISO" = c.country_iso3
),
yearly_rates as (
  select y.*, f.min_rate, f.max_rate, f.avg_rate
  from yearly_currency y left join fx_yearly f on y.currency = f.currency and y.year = f.year
  where y.year between {Y0} and {Y1}
),
yearly_mart as (
  select y.*, w.country_id, w.country_name, w.external_debt, w.gdp, w.import,
         w.industry_in_gdp, w.inflation, w.population, w.services_in_gdp, w.trade_in_gdp,
         w."countryISO3", w.gdp_per_capita
  from yearly_rates y
  left join indicators_wide w on y."partnerISO" = w."countryISO3" and y.year = w.year
)
"""


def q(body: str, extra: str = "") -> str:
    """Prefix a statement with the shared CTEs (plus statement-local ones)."""
    ctes = CTES.strip() + (",\n" + extra.strip() if extra.strip() else "")
    return f"with {ctes}\n{body.strip()}\n"


ORACLE: dict[str, str] = {}


def register(name: str, body: str, extra: str = "") -> None:
    ORACLE[name] = q(body, extra)


from portolan.plans import oracle_queries  # noqa: E402,F401  (registers the statements)
