"""The same operators over input files (the production path) give the same
results as over the driver-table adapter."""

import tempfile

from portolan.plans import marts
from portolan.plans.params import QUERY_YEARS
from portolan.plans.context import Domain, FileDomain
from tests.conftest import SMALL


def test_file_domain_matches_adapter(spark):
    d = Domain(spark, SMALL)
    root = tempfile.mkdtemp(prefix="inputs-")
    d.trade_raw.write.parquet(f"{root}/trade")
    d.fx_raw.write.parquet(f"{root}/fx")
    wdi = d.wdi_raw
    for i, year in enumerate(sorted(r.year for r in wdi.select("year").distinct().collect())):
        wdi.filter(wdi.year == year).write.parquet(f"{root}/wdi/part{i}.parquet")
    d.iso_dim.write.parquet(f"{root}/codes")
    d.currency_dim.write.parquet(f"{root}/currency")
    f = FileDomain(spark, f"{root}/trade", f"{root}/fx", f"{root}/wdi/*.parquet",
                   f"{root}/codes", f"{root}/currency")
    for build in (marts.trade_yearly, marts.yearly_mart, marts.monthly_mart):
        a, b = build(d, QUERY_YEARS), build(f, QUERY_YEARS)
        cols = sorted(a.columns)
        assert sorted(b.columns) == cols
        assert sorted(str(tuple(r)) for r in a.select(cols).collect()) == \
            sorted(str(tuple(r)) for r in b.select(cols).collect())
