"""Every registered query of the warehouse against its DuckDB oracle on the smallest test scale.

Values are compared order-insensitively after sorting columns by name, the
same way the correctness gate does.
"""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from dwspark.plans.registry import all_queries
from dwspark.sources.tables import TABLE_NAMES
from oracle.queries import oracle_queries

SF = os.environ.get("DWSPARK_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLE = all_queries(), oracle_queries()
NAMES = sorted(QUERIES)


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "venta_neta" in df.columns


def test_every_query_has_an_oracle():
    assert sorted(set(NAMES) - set(ORACLE)) == []
    assert set(NAMES) <= set(E.queries()) and {n: ORACLE[n] for n in NAMES}.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = df.collect()
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)
