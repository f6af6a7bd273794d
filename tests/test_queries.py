"""Every registered query of the library, except those of the training-data subpackage, against its SQL where it has one."""

import glob
import os

import duckdb
import pytest

from tessera.plans import answers, backtrace, cleaning, recovery, relational, scalars

SF = "/root/testdata/sf0.001"
QUERIES = scalars.queries() | relational.queries() | cleaning.queries() | backtrace.queries() | recovery.queries() | answers.queries()
SQL = scalars.oracle_sql() | relational.oracle_sql() | cleaning.oracle_sql() | backtrace.oracle_sql() | recovery.oracle_sql() | answers.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


#: Scans for what the test tables need not hold.
MAY_BE_EMPTY = {"snk_risk_scan", "j_abbr_not_known"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows or name in MAY_BE_EMPTY
    assert all(any(v is not None for v in r) for r in rows)
