"""Every registered query of the library against its SQL on DuckDB, on the smallest tables."""

import os

import pytest

from obskit.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def db():
    import duckdb

    from obskit.plans.base import TABLES

    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    from tools.compare import rows_of

    df = QUERIES[name](spark, SF)
    mine = rows_of(df.columns, df.collect())
    if name in ORACLE_SQL:
        cur = db.execute(ORACLE_SQL[name])
        assert mine == rows_of([d[0] for d in cur.description], cur.fetchall())
    else:
        assert mine[1]
