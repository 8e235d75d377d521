"""What the runs and the post-build suite deal, write and keep on disk."""

import os
import time

import pytest
from dwspark.functions.keys import packed, unpacked
from dwspark.operators import quality as Q
from dwspark.plans import checks as CH
from dwspark.plans import run as R
from dwspark.plans.build import LINES, write_star
from dwspark.plans.warehouse import Warehouse
from dwspark.session import FREE_SHUFFLES, scratch_path
from dwspark.sources import audit as A
from dwspark.sources.store import Store
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_packed_keys_are_one_to_one_and_half_as_long(spark):
    md5 = "0123456789abcdef" * 2
    keys = [md5, md5.upper(), md5 + "\n", md5[:-1] + "g", "ÿ" + "a" * 16, "a" * 16, "", "7", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed("k").alias("p"))
    got = {r["k"]: (r["p"], r["u"]) for r in df.select("*", unpacked("p").alias("u")).collect()}
    assert {k: u for k, (_, u) in got.items()} == {k: k for k in keys}
    assert len({None if p is None else bytes(p) for p, _ in got.values()}) == len(keys) and len(got[md5][0]) == 17


def test_combinations_with_nulls_are_told_apart(spark):
    t = spark.createDataFrame([(1, None), (None, "1"), (1, None), (1, "null"), (11, ""), (1, "1")], "a int, b string")
    tests = [Q.Test("unique_combination", "t", None, {"columns": ["a", "b"]}), Q.Test("unique", "t", "b")]
    assert [r.failing_rows for r in Q.run_tests(spark, {"t": t}, tests).collect()] == [1, 1]


def test_missing_keys_find_their_rows_where_they_are(spark, no_broadcast):
    rows = spark.createDataFrame([(1, 5), (2, 6), (3, None), (4, 6)], "id long, k long")
    parents = spark.createDataFrame([(5,)], "k long")
    assert sorted(r.id for r in CH._without(rows, "k", parents).collect()) == [2, 3, 4]
    assert sorted(r.id for r in CH._without(rows, "k", parents, null_safe=False).collect()) == [2, 4]
    none = CH._without(rows, "k", parents.union(rows.select("k")), null_safe=False).where("id < 3")
    assert none.count() == 0 and "Exchange hashpartitioning" not in _plan(none)


def test_raw_checks_read_the_loaded_tables(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    w.store = w.fx.store = Store(spark, scratch_path(spark, "raw"))
    counts, tables = CH._load_raw(w)
    raw = CH._over(w.copy(), tables)
    for check in (CH.i24_null_keys, CH.i25_duplicate_keys, CH.i26_null_measures):
        assert "lineitem.parquet" not in _plan(check(raw)), check.__name__
    assert sorted(map(str, CH.i26_null_measures(raw).collect())) == sorted(map(str, CH.i26_null_measures(w).collect()))
    assert {r.failing_rows for r in counts.collect()} == {0} and len(tables) == len(CH.RECONCILED)


def test_a_write_leaves_no_shuffle_files(spark, tmpdir_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for _, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    Store(spark, tmpdir_path).full("t", spark.range(1000).repartition(4, "id"))
    for _ in range(40):
        if files() <= before:
            break
        time.sleep(0.5)
    assert files() <= before
    assert spark.conf.get(FREE_SHUFFLES, "false") == "false"


def test_children_of_a_batch_are_found_where_they_are_read(spark, sf_dir, no_broadcast):
    store, fx = Store(spark, scratch_path(spark, "children")), Warehouse(spark, sf_dir).fx
    venta, linea = (next(s for s in R.SOURCES if s.name == n) for n in ("venta", "linea"))
    R.load_sources(store, fx, "b1", [venta, linea])
    got = R.extract(store, fx, linea)
    assert "BroadcastHashJoin" in _plan(got) and "LeftSemi" in _plan(got)
    since = F.lit(A.watermark_of(store, "venta")).cast("date") - F.expr("interval 3 days")
    sold = fx.venta().where(F.col("fecha") >= since).select("id_venta")
    assert 0 < got.count() == fx.linea().join(sold, "id_venta").count() < fx.linea().count()


def test_declared_tests_are_counted_before_the_checks(spark, sf_dir):
    got = R.staging_results(Warehouse(spark, sf_dir))
    assert "domain" not in _plan(got) and got.count() == 97 + 7


def test_lines_of_a_star_go_when_it_is_written(spark, sf_dir, tmpdir_path):
    store = Store(spark, tmpdir_path)
    assert len(write_star(store, Warehouse(spark, sf_dir))) == 14
    assert os.listdir(f"{tmpdir_path}/{LINES}") == []


def test_a_month_has_files_by_its_size_not_one_of_each_task(spark, sf_dir, tmpdir_path):
    store, w = Store(spark, tmpdir_path), Warehouse(spark, sf_dir)
    lines = store.full(LINES, w.int_ventas_lineas.repartition(6))
    written = w.copy(**{LINES: store.frame(lines)})
    expected = written.fct_ventas.agg(F.count("*"), F.sum("monto_neto"), F.countDistinct("sk_fecha")).first()
    got = store.frame(write_star(store, written, lines)["fct_ventas"])
    months = got.select("mes_particion").distinct().count()
    assert months > 12 and len(got.inputFiles()) == months
    assert got.agg(F.count("*"), F.sum("monto_neto"), F.countDistinct("sk_fecha")).first() == expected


def test_checks_of_a_suite_are_counted_a_few_at_a_time(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    checks = [Q.Check(f"c{i}", "t", Q.ERROR, w.stg_sucursal.where(F.col("id_sucursal") < i)) for i in range(2 * R.CHECKS_AT_ONCE + 1)]
    got = R._checked(w, checks)
    assert "nation.parquet" not in _plan(got) and len({f.split("/")[-2] for f in got.inputFiles()}) == 3
    assert {r.check_name: r.failing_rows for r in got.collect()} == {f"c{i}": i for i in range(len(checks))}


def test_keys_of_declared_tests_are_not_made_by_the_interpreter(spark):
    t = spark.createDataFrame([("a" * 32, 1), ("a" * 32, None), (None, 7)], "k string, n int")
    p = spark.createDataFrame([("b" * 32,)], "k string")
    tests = [Q.Test("unique", "t", "k"), Q.Test("relationships", "t", "k", {"to": "p", "field": "k"}), Q.Test("not_null", "t", "n"), Q.Test("accepted_range", "t", "n", {"min_value": 5})]
    got = Q.run_tests(spark, {"t": t, "p": p}, tests)
    assert [(r.check_type, r.failing_rows) for r in got.orderBy("check_type").collect()] == [("accepted_range", 1), ("not_null", 1), ("relationships", 2), ("unique", 1)]
    plan = _plan(got)
    assert "lambda" not in plan and "RLIKE" not in plan
