"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from conftest import SMALL

from tidemark.plans import catalog
from tidemark.plans.views import TABLES
from tools.check_oracle import rows_of

CATALOG = catalog()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_sql(spark, duck, name):
    query = CATALOG[name]
    df = query.run(spark, SMALL)
    got = df.collect()
    if query.sql is None:
        assert got
        return
    cur = duck.execute(query.sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, cur.fetchall())
