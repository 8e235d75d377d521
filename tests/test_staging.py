"""Typed CSV staging: good rows, rejected cells with their place, threshold; quarantine of rows with all their failures."""

import datetime as dt
import json
import os

import pytest
from dwspark.operators import quality as Q
from dwspark.sources.staging import CsvSpec, TooManyRejects, good_rows, rejects, stage_csv
from dwspark.sources.store import Store

SPEC = CsvSpec({"id": "int", "day": "date", "price": "decimal(6,2)", "note": "string"}, ("id",))


def staged(spark, folder, text, **kw):
    path = os.path.join(folder, "f.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    store = Store(spark, os.path.join(folder, "s"))
    base = store.snapshot()
    store.commit({"t": stage_csv(store, "t", path, SPEC, **kw)}, base)
    return store.read("t")


def test_rows_cells_and_reasons(spark, tmpdir_path):
    text = "﻿id,day,price,note\n1,2020-01-02,3.50, a \nx,2020-13-01,3.5,b\n,2020-01-01,,\n4,,12345678,c\n\n5,2020-02-29,-1,é\n"
    df = staged(spark, tmpdir_path, text, max_bad_share=0.7)
    good = sorted((r["id"], r["day"], str(r["price"]), r["note"], r["_row_number"]) for r in good_rows(df).collect())
    assert good == [(1, dt.date(2020, 1, 2), "3.50", "a", 2), (5, dt.date(2020, 2, 29), "-1.00", "é", 7)]
    bad = sorted((r["_row_number"], r["columna"], r["valor"] or "", r["motivo"]) for r in rejects(df).collect())
    assert bad == [(3, "day", "2020-13-01", "not a date"), (3, "id", "x", "not a int"), (4, "id", "", "missing"), (5, "price", "12345678", "not a decimal(6,2)")]
    assert all(r["_file"].endswith("f.csv") for r in rejects(df).collect())


def test_too_many_rejects_publish_nothing(spark, tmpdir_path):
    with pytest.raises(TooManyRejects, match="1 of 2 rows"):
        staged(spark, tmpdir_path, "id,day,price,note\n1,2020-01-02,1,a\nx,2020-01-02,1,a\n", max_bad_share=0.4)
    assert Store(spark, os.path.join(tmpdir_path, "s")).read("t") is None
    assert good_rows(staged(spark, tmpdir_path, "id,day,price,note\n1,2020-01-02,1,a\n")).count() == 1


def test_quarantined_rows_carry_all_their_failures(spark, tmpdir_path):
    child = spark.createDataFrame([(1, 10, 5), (1, 99, -1), (2, None, 7), (3, 10, None), (None, 10, 1)], "id int, parent int, amount int")
    parent = spark.createDataFrame([(10,), (11,)], "key int")
    tables = {"child": child, "parent": parent}
    tests = [
        Q.Test("unique", "child", "id"), Q.Test("not_null", "child", "id"), Q.Test("relationships", "child", "parent", {"to": "parent", "field": "key"}),
        Q.Test("accepted_range", "child", "amount", {"min_value": 0}), Q.Test("unique_combination", "child", None, {"columns": ["id", "parent"]}),
    ]
    singular = Q.Check("big", "singular", Q.ERROR, child.where("amount > 6"))
    Q.store_failures(tests, tables, os.path.join(tmpdir_path, "q"), checks=[singular])
    found = spark.read.parquet(os.path.join(tmpdir_path, "q")).collect()
    u, n, r, a = "unique_child_id", "not_null_child_id", "relationships_child_parent", "accepted_range_child_amount"
    got = sorted((x["check_name"], json.loads(x["fila"]).get("amount", 0), tuple(x["fallas"])) for x in found)
    assert got == sorted([(u, 5, (u,)), (u, -1, (u, r, a)), (r, -1, (u, r, a)), (a, -1, (u, r, a)), (n, 1, (n,)), ("big", 7, ("big",))])
    counts = {r["check_name"]: r["failing_rows"] for r in Q.run_tests(spark, tables, tests).collect()}
    assert counts == {u: 1, n: 1, r: 1, a: 1, "unique_combination_child_id_parent": 0}
