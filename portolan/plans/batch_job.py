"""The batch job: build every mart, view and serving table and write them.

Fault tolerance and lineage: the monthly trade features -- the common input
of every mart and view -- are computed once and written (partitioned by
year) under the shared folder named by ``spark.checkpoint.dir``.  Every
later stage reads that table back, so a lost executor costs a re-read of
those files, not a recomputation of the source joins, and each output is an
overwrite (a re-run replaces it).  The joins of the marts are guarded: rows are
counted before and behind them while the mart is written, and a difference fails
the job.  Serving tables are published in one step, behind a gate on colliding
keys, and, if a client factory is given, staged and committed through it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from portolan.operators import serving as srv
from portolan.operators import views as vw
from portolan.operators.fx import fx_monthly, fx_yearly
from portolan.operators.features import trade_features
from portolan.operators.joins import FanOutError
from portolan.plans import marts
from portolan.plans.context import MART_YEARS, Domain
from portolan.sources.lake import LakePaths, materialize_counted, write_table


def build_all(d: Domain, lake: LakePaths, years: tuple[int, int] = MART_YEARS,
              client_factory: Callable[[str], Callable[[], object]] | None = None,
              row_counts: dict[str, int] | None = None) -> dict[str, str]:
    """Write every table; returns name -> path.  If ``row_counts`` is a
    dict it receives each written table's row count, observed during the
    write itself (DQ-11 at no extra pass).  ``client_factory(table)`` gives the
    factory of clients that stage and commit that serving table."""
    spark = d.spark
    counts = row_counts if row_counts is not None else {}
    d.features, counts["monthly_features"] = materialize_counted(
        trade_features(d.trade_raw, d.iso_dim), "monthly_features", ["year"])
    out: dict[str, str] = {}

    def emit(name: str, df: DataFrame, partition_by: list[str] | None = None, expected: int | None = None) -> None:
        path = lake.table(name)
        obs = Observation(f"rows-{name}")
        write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by)
        counts[name] = int(obs.get["rows"])
        if expected is not None and counts[name] != expected:
            raise FanOutError(f"{name}: {expected} rows before the joins, {counts[name]} behind them")
        out[name] = path

    def in_years(df: DataFrame) -> int:
        # the year folders of a written table: counted from file footers
        return marts.year_range(df, years).count()

    yearly, counts["trade_yearly"] = materialize_counted(marts.trade_yearly(d), "trade_yearly", ["year"])
    yearly_currency = marts.with_currency(yearly, d)

    # the features are written: their totals are cheap to read, and with the
    # totals broadcast the rows are not exchanged
    emit("monthly", marts.monthly_mart(d, years, strategy="join"), ["year"], in_years(d.features))
    emit("yearly_currency", yearly_currency, ["year"], counts["trade_yearly"])
    emit("yearly", marts.yearly_mart(d, years), ["year"], in_years(yearly))
    emit("fx_monthly", fx_monthly(d.fx_raw))
    emit("fx_yearly", fx_yearly(d.fx_raw))
    emit("indicators", marts.indicators(d))

    views = {
        "trade_time": (vw.trade_time_view(marts.monthly_features(d), ordered=False),
                       srv.trade_time_key(), "stats", srv.TRADE_TIME_CELLS),
        "commodity_ranking": (vw.commodity_ranking_view(yearly, ordered=False),
                              srv.commodity_key(), "info", srv.COMMODITY_CELLS),
        "partner_market_share": (vw.partner_share_view(yearly, ordered=False),
                                 srv.partner_year_key(), "info", srv.PARTNER_CELLS),
        "economic_structure": (vw.economic_structure_view(spark.read.parquet(out["yearly"]), ordered=False),
                               srv.partner_key(), "info", srv.ECONOMIC_CELLS),
    }
    # all versions are staged and checked before one of them becomes the table
    staged = []
    for name, (view, key, family, cells) in views.items():
        table = srv.PublishedTable(spark, lake.serving(name))
        version = table.stage(srv.to_serving(view, key, family, cells))
        table.check(version)
        staged.append((name, table, version))
    for name, table, version in staged:
        table.switch(version)
        out[f"serving/{name}"] = table.location(version)
        if client_factory is not None:
            srv.publish_with_client(table.read(), client_factory(name))
    return out
