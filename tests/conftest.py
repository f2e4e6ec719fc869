import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from portolan.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ORACLE_SF = os.environ.get("PORTOLAN_TEST_SF", SMALL)


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="portolan-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from portolan.sources.tables import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{ORACLE_SF}/{t}.parquet')")
    return con
