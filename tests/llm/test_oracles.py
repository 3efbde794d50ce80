"""The queries that SQL can express against DuckDB at sf0.01."""

import os

import duckdb
import pytest

from meterlens.llm.oracle import ORACLE
from meterlens.llm.queries import QUERIES
from meterlens.sources.tables import TABLES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=str) == sorted(cur.fetchall(), key=str)
