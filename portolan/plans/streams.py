"""Registered streaming queries.

Each runs its Structured Streaming job to completion over the files present
(``availableNow``), into a fresh folder under the shared checkpoint root,
and returns the resulting table as a batch DataFrame.  The oracle for each
is the equivalent batch SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from portolan.functions.columns import fixed_sum
from portolan.operators import serving as srv
from portolan.operators.features import trade_features
from portolan.plans import marts
from portolan.plans.catalog import query
from portolan.plans.context import Domain
from portolan.session import scratch_path
from portolan.sources import adapter
from portolan.streaming import jobs
from portolan.streaming.sinks import read_appended, read_latest


def _folders(d: Domain, name: str) -> tuple[str, str]:
    base = scratch_path(d.spark, name)
    return f"{base}/table", f"{base}/_checkpoint"


def _weekly(d: Domain) -> tuple[jobs.WeeklyRates, DataFrame]:
    """The weekly job, run over the files present, and its stream of rates."""
    table, ckpt = _folders(d, "rates_weekly")
    job = jobs.WeeklyRates(table)
    rates = jobs.rate_events(jobs.file_stream(d.spark, d.sf_dir, "events"))
    job.start(rates, ckpt).awaitTermination()
    return job, rates


@query("rates_weekly_stream")
def rates_weekly_stream(d: Domain) -> DataFrame:
    """STR-2 / STR-5: weekly rate table kept by a stream with a watermark."""
    return _weekly(d)[0].weeks(d.spark)


@query("rates_weekly_account_stream")
def rates_weekly_account_stream(d: Domain) -> DataFrame:
    """STR-5: rows in, rows in the table and late rows of the weekly job."""
    job, rates = _weekly(d)
    return job.account(d.spark, rates.schema)


@query("rates_monthly_stream")
def rates_monthly_stream(d: Domain) -> DataFrame:
    """STR-3 / STR-5: monthly rate table (update mode, upsert by key)."""
    table, ckpt = _folders(d, "rates_monthly")
    agg = jobs.monthly_rates(jobs.rate_events(jobs.file_stream(d.spark, d.sf_dir, "events")))
    keys = ["currency", "month_start"]
    jobs.run_upsert(agg, table, ckpt, keys).awaitTermination()
    return read_latest(d.spark, table, keys, agg.schema)


def _landing(d: Domain) -> tuple[jobs.EventLanding, DataFrame]:
    table, ckpt = _folders(d, "events_landed")
    job, events = jobs.EventLanding(table), jobs.file_stream(d.spark, d.sf_dir, "events")
    job.start(events, ckpt).awaitTermination()
    return job, events


@query("events_landed_stream")
def events_landed_stream(d: Domain) -> DataFrame:
    """STR-1: records landed as typed rows."""
    job, events = _landing(d)
    return job.outcome(d.spark, events)


@query("events_outcomes_stream")
def events_outcomes_stream(d: Domain) -> DataFrame:
    """STR-1: number of records by outcome (landed, broken JSON, late ...)."""
    job, events = _landing(d)
    return job.outcomes(d.spark, events)


def _trade_stream(d: Domain) -> DataFrame:
    lines = jobs.file_stream(d.spark, d.sf_dir, "lineitem")
    return trade_features(adapter.trade_raw(d.tables, lineitem=lines), d.iso_dim)


@query("trade_enriched_stream")
def trade_enriched_stream(d: Domain) -> DataFrame:
    """STR-4: trade lines streamed, joined to static tables, conformed and
    enriched with the currency dimension (stream-static broadcast joins)."""
    table, ckpt = _folders(d, "trade_enriched")
    enriched = marts.with_currency(_trade_stream(d), d)
    jobs.run_append(enriched, table, ckpt).awaitTermination()
    return read_appended(d.spark, table, enriched.schema)


@query("trade_totals_stream")
def trade_totals_stream(d: Domain) -> DataFrame:
    """STR-4: the month world totals per (period, hs_code) as a separate
    streaming aggregate (windows over all rows are not allowed on streams)."""
    table, ckpt = _folders(d, "trade_totals")
    agg = (_trade_stream(d).groupBy("data_period", "hs_code")
           .agg(fixed_sum("primary_value_usd").alias("month_world_export_value")))
    keys = ["data_period", "hs_code"]
    jobs.run_upsert(agg, table, ckpt, keys).awaitTermination()
    return read_latest(d.spark, table, keys, agg.schema)


@query("serving_rates_weekly")
def serving_rates_weekly(d: Domain) -> DataFrame:
    """STR-5: the streamed weekly rate table as serving cells (family
    ``rates``), keyed ``currency_weekstart``."""
    return srv.to_cells(rates_weekly_stream(d), srv.rate_week_key(), "rates", srv.RATE_CELLS)


@query("serving_rates_monthly")
def serving_rates_monthly(d: Domain) -> DataFrame:
    """STR-5: the streamed monthly rate table as serving cells."""
    return srv.to_cells(rates_monthly_stream(d), srv.rate_month_key(), "rates", srv.RATE_CELLS)
