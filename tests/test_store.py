"""The store: one state of all tables, merges of touched buckets only, races of publishers."""

import os
import random
import threading

import pytest
from dwspark.sources import store as S
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def publish(store, base=None, **tables):
    return store.commit(tables, base or store.snapshot())


def test_create_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "a", "0001")
    assert S.create_once(spark, path, "first é") and not S.create_once(spark, path, "second")
    assert S.read_text(spark, path) == "first é"
    assert os.listdir(os.path.dirname(path)).count("0001") == 1 and not [f for f in os.listdir(os.path.dirname(path)) if f.endswith(".draft")]


def test_merge_rewrites_touched_buckets_only(spark, tmpdir_path):
    store = S.Store(spark, tmpdir_path)
    data = spark.range(1000).select("id", (F.col("id") * 2).alias("v"), F.lit("old").alias("w"))
    first = publish(store, t=store.keyed("t", data, "id", buckets=16)).tables["t"]
    assert first.counts["rows"] == 1000 and len(first.parts) == 16
    batch = spark.createDataFrame([(3, -1, "new"), (5000, -2, "new")], "id long, v long, w string")
    merged = store.merge("t", batch, "id", batch=F.col("w") == "new")
    assert (merged.counts["rows"], merged.counts["batch_rows"]) == (2, 2)
    changed = [b for b in merged.parts if merged.parts[b] != first.parts[b]]
    assert 1 <= len(changed) <= 2
    before = {b: os.listdir(os.path.join(tmpdir_path, p)) for b, p in first.parts.items()}
    # nothing is seen before it is published, and the old state stays readable after
    assert store.read("t").count() == 1000
    old = store.snapshot()
    publish(store, t=merged)
    assert store.read("t", old).count() == 1000
    want = sorted([(i, 2 * i, "old") for i in range(1000) if i != 3] + [(3, -1, "new"), (5000, -2, "new")], key=str)
    assert rows(store.read("t")) == want
    now = store.snapshot().tables["t"].parts
    for b, p in now.items():
        if b not in changed:
            assert p == first.parts[b] and os.listdir(os.path.join(tmpdir_path, p)) == before[b]


def test_merges_equal_a_dictionary(spark, tmpdir_path):
    rng, store, model = random.Random(4), S.Store(spark, tmpdir_path), {}
    for _ in range(5):
        batch = {(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice("ab")): rng.random() for _ in range(rng.randint(0, 6))}
        df = spark.createDataFrame([(*k, v) for k, v in batch.items()], "k int, g string, v double")
        publish(store, t=store.merge("t", df, ["k", "g"], buckets=4))
        # a null key equals no other key, as in an anti-join, so its rows add up
        nulls = [(*k, v) for k, v in batch.items() if k[0] is None]
        model.setdefault("null", []).extend(nulls)
        model.update({k: v for k, v in batch.items() if k[0] is not None})
    want = [(*k, v) for k, v in model.items() if k != "null"] + model["null"]
    assert rows(store.read("t")) == sorted(want, key=str)
    with pytest.raises(ValueError, match="not keyed"):
        store.merge("t", df, "k")


def test_append_is_idempotent_by_batch(spark, tmpdir_path):
    store = S.Store(spark, tmpdir_path)
    for batch, n in (("a", 3), ("b", 2), ("a", 4)):
        publish(store, log=store.append("log", spark.range(n).withColumn("batch", F.lit(batch)), batch))
    assert store.read("log").groupBy("batch").count().orderBy("batch").collect() == [("a", 4), ("b", 2)]


def test_racing_publishers(spark, tmpdir_path):
    store = S.Store(spark, tmpdir_path)
    publish(store, x=store.full("x", spark.range(1)), y=store.full("y", spark.range(1)))
    base = store.snapshot()
    stars = [{n: store.full(n, spark.range(size)) for n in ("x", "y")} for size in (10, 20)]
    gate, outcome = threading.Barrier(2), []

    def run(changes):
        gate.wait()
        try:
            outcome.append(S.Store(spark, tmpdir_path).commit(changes, base).number)
        except S.Conflict:
            outcome.append("conflict")

    threads = [threading.Thread(target=run, args=(s,)) for s in stars]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(outcome, key=str) == [2, "conflict"]
    sizes = {store.read(n).count() for n in ("x", "y")}
    assert sizes in ({10}, {20})
    # changes of other tables or other parts don't conflict, whoever is first
    base = store.snapshot()
    publish(store, base, z=store.full("z", spark.range(3)))
    publish(store, base, x=store.full("x", spark.range(7)))
    assert (store.read("x").count(), store.read("z").count()) == (7, 3)
    base = store.snapshot()
    a, b = (store.append("log", spark.range(n), f"batch{n}", base) for n in (1, 2))
    publish(store, base, log=a)
    publish(store, base, log=b)
    assert store.read("log").count() == 3
    with pytest.raises(S.Conflict):
        publish(store, base, log=store.append("log", spark.range(5), "batch1", base))


def test_expire_keeps_what_live_states_name(spark, tmpdir_path):
    store = S.Store(spark, tmpdir_path)
    publish(store, t=store.keyed("t", spark.range(100).toDF("id"), "id", buckets=4), u=store.full("u", spark.range(2)))
    for n in (1, 2, 3):
        publish(store, t=store.merge("t", spark.createDataFrame([(n,)], "id long"), "id"))
    assert store.expire(keep=2) == 2 and len(store.numbers()) == 2
    assert store.read("t").count() == 100 and store.read("u").count() == 2
    assert store.read("t", store.snapshot(store.numbers()[0])).count() == 100


def test_partitioned_tables_keep_their_partitions(spark, tmpdir_path):
    store = S.Store(spark, tmpdir_path)
    df = spark.range(20).select("id", (F.col("id") % 4).cast("int").alias("p"), F.lit("x").alias("v"))
    publish(store, t=store.full("t", df, partition_by=["p"]))
    assert rows(store.read("t").select("id", "p", "v")) == rows(df)
    assert "PartitionFilters: [isnotnull(p" in store.read("t").where("p = 1")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
