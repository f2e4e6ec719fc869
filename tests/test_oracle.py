"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive exact values)."""

import math

import pytest

import __spark_entry__ as E
from portolan.plans.catalog import QUERIES
from tests.conftest import ORACLE_SF

NAMES = sorted(QUERIES)  # the training-data queries have tests of their own


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_every_query_is_checked():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, ORACLE_SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "share_of_year_market" in df.columns
