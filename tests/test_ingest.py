"""CSV contract, row numbers, blank handling, versioned loads, streaming upsert."""

import os

import pytest
from pyspark.sql import functions as F

from dwspark.sources import ingest as I
from dwspark.sources import loads as L
from dwspark.streaming.upsert import stream_upsert

COLS = ["id", "nombre", "monto"]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_header_contract_bom_case_spaces(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "a.csv")
    _write(p, "﻿ ID , Nombre,MONTO\n1, ana ,\"1,5\"\n\n , , \n2,bob,3\n")
    df = I.read_csv_contract(spark, p, COLS)
    rows = sorted(map(tuple, df.collect()))
    assert rows == [("1", "ana", "1,5"), ("2", "bob", "3")]  # blank line and all-blank record skipped, quoted comma kept


def test_wrong_header_rejected(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "b.csv")
    _write(p, "id,name,monto\n1,a,2\n")
    with pytest.raises(I.ContractError):
        I.read_csv_contract(spark, p, COLS)


@pytest.mark.parametrize("body", ["1,a\n", "1,a,2,extra\n"])
def test_ragged_rows_rejected(spark, tmpdir_path, body):
    p = os.path.join(tmpdir_path, "c.csv")
    _write(p, "id,nombre,monto\n" + body)
    with pytest.raises(Exception):
        I.read_csv_contract(spark, p, COLS).collect()


def test_row_numbers_count_header_and_blank_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "d.csv")
    lines = ["id,nombre,monto"] + [f"{i},n{i},{i}" if i % 7 else "" for i in range(1, 400)]
    _write(p, "\n".join(lines) + "\n")
    df = I.read_csv_numbered(spark, p, COLS)
    got = {int(r.id): r._row_number for r in df.collect()}
    assert all(got[i] == i + 1 for i in got)  # header is record 1, blank records still counted
    assert len(got) == len([i for i in range(1, 400) if i % 7])


def test_row_numbers_across_splits(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "e.csv")
    lines = ["id,nombre,monto"] + [f"{i},{'x' * 50},{i}" for i in range(1, 5001)]
    _write(p, "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = I.read_csv_numbered(spark, p, COLS)
        assert df.rdd.getNumPartitions() > 1
        bad = df.filter(F.col("_row_number") != F.col("id").cast("bigint") + 1).count()
        assert bad == 0 and df.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_versioned_full_and_merge_load(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    L.full_load(a, root)
    L.full_load(a, root)
    assert sorted(map(tuple, L.read_current(spark, root).collect())) == [(1, "a"), (2, "b")]
    L.merge_load(spark, root, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "k")
    assert sorted(map(tuple, L.read_current(spark, root).collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_watermark_advances_from_extracted_rows(spark):
    wm = spark.createDataFrame([], L.WATERMARK_SCHEMA)
    b1 = spark.createDataFrame([(1,), (5,)], "x int")
    wm = L.advance_watermark(wm, "s", "x", b1)
    wm = L.advance_watermark(wm, "s", "x", spark.createDataFrame([], "x int"))  # empty batch: unchanged
    assert [r.last_value for r in wm.collect()] == ["5"]


def test_stream_upsert_idempotent(spark, tmpdir_path):
    src, tgt, ck = (os.path.join(tmpdir_path, n) for n in ("src", "tgt", "ck"))
    schema = "k int, v string, ts int"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema).write.mode("append").parquet(src)
    stream_upsert(spark, src, spark.createDataFrame([], schema).schema, tgt, "k", ck, order=["ts"])
    spark.createDataFrame([(2, "B", 2), (3, "c", 2), (3, "c2", 3)], schema).write.mode("append").parquet(src)
    stream_upsert(spark, src, spark.createDataFrame([], schema).schema, tgt, "k", ck, order=["ts"])
    v1 = L.current_version(spark, tgt)
    stream_upsert(spark, src, spark.createDataFrame([], schema).schema, tgt, "k", ck, order=["ts"])
    assert L.current_version(spark, tgt) == v1  # nothing new: no new version
    assert sorted(map(tuple, L.read_current(spark, tgt).collect())) == [(1, "a", 1), (2, "B", 2), (3, "c2", 3)]


def test_insert_missing_first_wins(spark):
    inc = spark.createDataFrame([("x", "first", 1), ("x", "second", 2), ("y", "y1", 3)], "k string, v string, o int")
    d1 = L.insert_missing(None, inc.filter("o < 3"), "k", ["o"]).select("k", "v")
    assert sorted(map(tuple, d1.collect())) == [("x", "first")]
    d2 = L.insert_missing(d1, inc, "k", ["o"])
    assert sorted(map(tuple, d2.collect())) == [("x", "first"), ("y", "y1")]


def test_contract_conform_and_violations(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", None), ("2", "b")], "a string, b string")
    c = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType(), False)])
    out = L.conform(df, c)
    assert out.schema["a"].dataType == T.IntegerType()
    v = {r.columna: r.nulos for r in L.contract_violations(df, c).collect()}
    assert v == {"b": 1}
    with pytest.raises(Exception, match="NOT NULL"):
        out.collect()
    with pytest.raises(L.ContractViolation):
        L.conform(df.drop("b"), c)


def test_numbered_reader_rejects_ragged_rows_and_strips_tabs(spark, tmpdir_path):
    import pytest

    def read(name, body):
        path = os.path.join(tmpdir_path, name)
        with open(path, "w") as f:
            f.write(body)
        return I.read_csv_numbered(spark, path, ["a", "b", "c"]).collect()

    rows = sorted(read("good.csv", 'a,b,c\n1,"x, y",\t\n\n \t,,\n2, q ,3\n'), key=lambda r: r["_row_number"])
    assert [(r["a"], r["b"], r["c"], r["_row_number"]) for r in rows] == [("1", "x, y", None, 2), ("2", "q", "3", 5)]
    for body in ("a,b,c\n4,5\n", "a,b,c\n6,7,8,9\n"):
        with pytest.raises(Exception, match="ragged"):
            read(f"bad{len(body)}.csv", body)
