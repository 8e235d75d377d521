"""Loads that must not lose data, and the stricter contract, SCD2 and pointer rules."""

import os

import pytest
from dwspark.operators.scd import scd2_apply
from dwspark.sources import loads as L
from dwspark.streaming.upsert import stream_upsert
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_keeps_the_target_when_the_pointer_cannot_be_read(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "t")
    L.full_load(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string"), root)
    batch = spark.createDataFrame([(3, "z")], "id int, v string")

    def broken(*_):
        raise OSError("store is away")

    with monkeypatch.context() as m:
        m.setattr(L, "_pointers", broken)
        with pytest.raises(OSError):
            L.merge_load(spark, root, batch, "id")
    assert rows(L.read_current(spark, root)) == [(1, "a"), (2, "b"), (3, "c")]
    L.merge_load(spark, root, batch, "id")
    assert rows(L.read_current(spark, root)) == [(1, "a"), (2, "b"), (3, "z")]


def test_an_unfinished_pointer_is_not_followed(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    L.full_load(spark.range(3), root)
    os.makedirs(os.path.join(root, L.POINTER, f"{7:012d}"))
    assert L.read_current(spark, root).count() == 3


def test_old_versions_go(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    for n in (1, 2, 3, 4):
        L.full_load(spark.range(n), root)
    assert L.expire_versions(spark, root, keep=2) == 2
    assert L.read_current(spark, root).count() == 4
    assert len([d for d in os.listdir(root) if d.startswith("v=")]) == 2
    assert L.read_current(spark, os.path.join(tmpdir_path, "never")) is None


def test_conform_refuses_nulls(spark):
    contract = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType(), True)])
    df = spark.createDataFrame([(1, None), (None, "x")], "k int, v string")
    assert rows(L.conform(df.filter("k = 1"), contract)) == [(1, None)]
    with pytest.raises(Exception, match="NOT NULL"):
        L.conform(df, contract).collect()


def test_defects_order_nulls_last(spark):
    df = spark.createDataFrame([(None, "n"), (2, "b"), (1, "a")], "k int, v string")
    out = L.inject_defect(df, 1, ["k"], "k", "v", None, "t").filter("_source is not null").collect()
    assert [(r["k"], r["v"]) for r in out] == [(990001, None)]
    out = L.inject_defect(df, 1, ["k"], None, "v", "x", "t").filter("_source is not null").collect()
    assert [(r["k"], r["v"]) for r in out] == [(2, "x")]


def test_scd2_same_day_and_back_dated(spark):
    new = lambda p: spark.createDataFrame([("k", p)], "id string, price int")
    h = scd2_apply(None, new(1), "id", ["price"], "2020-01-01")
    h = scd2_apply(h, new(2), "id", ["price"], "2020-01-01")
    assert [(r["price"], str(r["fecha_inicio_vigencia"]), r["es_actual"]) for r in h.collect()] == [(2, "2020-01-01", True)]
    with pytest.raises(Exception, match="goes back"):
        scd2_apply(h, new(3), "id", ["price"], "2019-01-01").collect()
    assert scd2_apply(h, new(2), "id", ["price"], "2019-01-01").count() == 1


def test_of_tied_deliveries_in_one_batch_the_last_wins(spark, tmpdir_path):
    src, target, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "target", "ckpt"))
    schema = "id int, ts int, v string"
    for n, v in ((1, "first"), (2, "second")):
        spark.createDataFrame([(1, 5, v), (n + 10, 1, v)], schema).coalesce(1).write.mode("append").parquet(src)
        for f in os.listdir(src):
            os.utime(os.path.join(src, f), (1_700_000_000 + 100 * n, 1_700_000_000 + 100 * n)) if v == "first" else None
    stream_upsert(spark, src, T._parse_datatype_string(schema), target, "id", ckpt, order=["ts"])
    assert rows(L.read_current(spark, target)) == [(1, 5, "second"), (11, 1, "first"), (12, 1, "second")]


def test_row_bound_counts_without_a_single_task(spark):
    from dwspark.operators.joins import row_bound_ok

    assert row_bound_ok(spark.range(10), 10) and not row_bound_ok(spark.range(11), 10)
    assert spark.range(3).select(F.lit(1)).count() == 3
