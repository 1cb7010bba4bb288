"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from factlake import catalogue

SF = "/root/testdata/sf0.001"
SQL = catalogue.oracle_sql()
QUERIES = catalogue.queries()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in at) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    yield con
    con.close()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
