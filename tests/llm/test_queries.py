"""The registered queries of this subpackage: those with SQL against DuckDB, the others by columns and rows."""

import os

import __spark_entry__ as E
import duckdb
import pytest
from dwspark.llm.queries import llm_queries
from dwspark.llm.sql import llm_sql
from dwspark.sources.tables import TABLE_NAMES

SF = os.environ.get("DWSPARK_TEST_SF", "/root/testdata/sf0.001")
QUERIES, SQL = llm_queries(), llm_sql()
# tested against brute force, the library, an exact round trip or held-out rows in this folder
NO_SQL = ["op10_learned_partitions", "op12_secret_scan", "op1_weak_supervision_pii", "op2_substring_dedup", "op4_token_counts", "op6_best_fit_packing", "op7_toxicity"]


def test_all_are_registered():
    assert sorted(set(QUERIES) - set(SQL)) == NO_SQL
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and SQL.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = con.execute(SQL[name])
    columns = sorted(d[0] for d in found.description)
    assert columns == sorted(df.columns)
    order = [[d[0] for d in found.description].index(c) for c in columns]
    assert sorted(str(tuple(r[c] for c in columns)) for r in rows) == sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())
