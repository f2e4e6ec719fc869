"""Run the batch job on files:

    python -m portolan --trade <parquet> --fx <parquet> \\
        --indicators '<dir>/*.parquet' --codes <parquet> --lake <root> \\
        [--years 2004 2023]

(on a cluster: ``spark-submit --py-files portolan.zip portolan/__main__.py``).
Writes the monthly / yearly marts, FX statistics, indicators and serving
tables under ``<root>/final_tables`` and prints the observed row counts.
"""

from __future__ import annotations

import argparse
import json

from portolan.plans.batch_job import build_all
from portolan.plans.context import FileDomain
from portolan.session import get_session
from portolan.sources.lake import LakePaths


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="portolan")
    p.add_argument("--trade", required=True, help="trade records (parquet)")
    p.add_argument("--fx", required=True, help="daily exchange rates (parquet, text dates)")
    p.add_argument("--indicators", required=True, help="long-form indicator files (glob)")
    p.add_argument("--codes", required=True, help="iso_numeric / iso2 / iso3 code table")
    p.add_argument("--codes-format", default="parquet", help="format of the code table")
    p.add_argument("--currency", default=None,
                   help="country -> currency table (default: the packaged one)")
    p.add_argument("--lake", required=True, help="root folder of the output tables")
    p.add_argument("--years", nargs=2, type=int, default=(2004, 2023),
                   help="inclusive year range of the marts")
    a = p.parse_args(argv)
    spark = get_session()
    d = FileDomain(spark, a.trade, a.fx, a.indicators, a.codes, a.currency, a.codes_format)
    counts: dict[str, int] = {}
    out = build_all(d, LakePaths(a.lake), tuple(a.years), row_counts=counts)
    print(json.dumps({"tables": out, "rows": counts}, indent=1))


if __name__ == "__main__":
    main()
