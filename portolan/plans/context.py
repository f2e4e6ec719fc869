"""Domain inputs for one driver folder, built lazily once per plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from portolan.sources import adapter
from portolan.sources.tables import Tables

# Year range of the marts (FLT-1); the registered queries pass their own
# (``params.QUERY_YEARS``).
MART_YEARS = (2004, 2023)


class Domain:
    """Adapter output for ``sf_dir``; every attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = Tables(spark, sf_dir)
        # Set by the batch job to a materialized (written) features table,
        # partitioned by year; the marts then read it instead of recomputing.
        self.features: DataFrame | None = None
        self._plans: dict[str, DataFrame] = {}

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Plan ``name``, built once per domain; a new domain lists its files anew."""
        if name not in self._plans:
            self._plans[name] = build()
        return self._plans[name]

    @property
    def trade_raw(self) -> DataFrame:
        return self.shared("trade_raw", lambda: adapter.trade_raw(self.tables))

    @property
    def iso_dim(self) -> DataFrame:
        return self.shared("iso_dim", lambda: adapter.iso_dim(self.tables))

    @property
    def currency_dim(self) -> DataFrame:
        return self.shared("currency_dim", lambda: adapter.currency_dim(self.tables))

    @property
    def fx_raw(self) -> DataFrame:
        return self.shared("fx_raw", lambda: adapter.fx_raw(self.tables))

    @property
    def wdi_raw(self) -> DataFrame:
        return self.shared("wdi_raw", lambda: adapter.wdi_raw(self.tables))


class FileDomain(Domain):
    """Domain inputs read from files instead of derived from driver tables:
    trade records, daily FX rates, indicator files (glob), the numeric /
    alpha-2 / alpha-3 code table, and the currency dimension (packaged one
    by default)."""

    def __init__(self, spark: SparkSession, trade: str, fx: str, indicators: str,
                 codes: str, currency: str | None = None, codes_format: str = "parquet"):
        super().__init__(spark, f"files:{trade}|{fx}|{indicators}|{codes}|{currency}")
        self.paths = dict(trade=trade, fx=fx, indicators=indicators, codes=codes,
                          currency=currency, codes_format=codes_format)

    @property
    def trade_raw(self) -> DataFrame:
        from portolan.sources.tables import read_trade
        return self.shared("trade_raw", lambda: read_trade(self.spark, self.paths["trade"]))

    @property
    def fx_raw(self) -> DataFrame:
        from portolan.sources.tables import read_fx
        return self.shared("fx_raw", lambda: read_fx(self.spark, self.paths["fx"]))

    @property
    def wdi_raw(self) -> DataFrame:
        from portolan.sources.tables import read_indicators
        return self.shared("wdi_raw", lambda: read_indicators(self.spark, self.paths["indicators"]))

    @property
    def iso_dim(self) -> DataFrame:
        from portolan.sources.dimensions import read_code_table
        return self.shared("iso_dim", lambda: read_code_table(
            self.spark, self.paths["codes"], self.paths["codes_format"]))

    @property
    def currency_dim(self) -> DataFrame:
        from portolan.sources.dimensions import currency_dimension
        path = self.paths["currency"]
        if path is None:
            return self.shared("currency_dim", lambda: currency_dimension(self.spark))
        return self.shared("currency_dim", lambda: self.spark.read.parquet(path).select(
            "country_iso3", "currency"))
