"""Every registered query against its DuckDB oracle at sf0.001 (the same
compare the driver runs at sf0.01): columns, row count, order-insensitive values."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from meterlens.plans.registry import all_oracles, all_queries
from conftest import SF_SMALL

from meterlens.sources.tables import TABLES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")


def norm(v):
    if v is None:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else repr(f)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = all_queries()[name](spark, SF_SMALL)
    scols = sdf.columns
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    orc = all_oracles()
    cur = duck.execute(orc[name])
    dcols = [d[0] for d in cur.description]
    drows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
    assert sorted(scols) == sorted(dcols)
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    k = lambda r: tuple("" if x is None else x for x in r)
    s = sorted((tuple(r[i] for i in order) for r in srows), key=k)
    d = sorted((tuple(r[i] for i in dorder) for r in drows), key=k)
    assert len(s) == len(d)
    assert s == d


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["consumer_type", "hour", "is_weekend", "avg_kwh", "p95_kwh", "p05_kwh",
                          "std_kwh", "sample_count", "day_type"]
    assert df.count() > 0


def test_every_query_has_an_oracle_and_is_registered():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(E.queries()) and set(all_oracles()) <= set(E.oracle_sql())
