"""Lines are dealt as often as their joins need, and sources with joins are derived once a shared warehouse."""

import pytest
from pyspark.sql import functions as F

from dwspark.operators import quality as Q
from dwspark.operators.joins import enrich_returns
from dwspark.plans.warehouse import Warehouse
from dwspark.session import scratch_path
from dwspark.sources import ingest as I
from dwspark.sources.store import Store


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture()
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_lines_are_dealt_by_product_once_and_by_sale_once(spark, sf_dir, no_broadcast):
    plan = _plan(Warehouse(spark, sf_dir).int_ventas_lineas)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and ("id_producto" in line or "id_venta" in line)]
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and any(f"({k}#" in line for k in ("l_partkey", "id_producto", "id_venta"))]
    # the lines twice, the parts for their price and for their cost, the sales
    assert len(joins) == 3 and len(dealt) == 5, dealt


def test_sources_with_joins_are_written_once(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    w.store = w.fx.store = Store(spark, scratch_path(spark, "once"))
    for df in (w.fx.inventario(), w.fx.devolucion(), w.fx.proveedor_precio(), w.stg_inventario, w.stg_devoluciones):
        assert "lineitem.parquet" not in _plan(df)
    assert "fct_ventas" not in _plan(w.fct_ventas)


def test_a_return_takes_the_flag_of_the_value_it_takes(spark):
    lines = spark.createDataFrame([(1, 1, 5, False), (1, 1, 7, True), (2, 1, 5, True), (2, 1, None, False), (3, 1, None, False)], "id_venta long, id_producto long, id_cliente long, ok boolean")
    lines = lines.withColumns({"fecha_venta": F.lit("1996-01-01").cast("date"), "id_sucursal": F.lit(1), "cantidad": F.lit(1), "monto_neto": F.lit(1).cast("decimal(14,2)")})
    returns = spark.createDataFrame([(str(i), i) for i in (1, 2, 3, 4)], "id_devolucion string, id_venta long").selectExpr(
        "id_devolucion", "date'1996-01-02' fecha_devolucion", "id_venta", "1L id_producto", "1 cantidad_devuelta", "'x' motivo")
    got = {r.id_venta: (r.id_cliente, r.ok) for r in enrich_returns(returns, lines, {"id_cliente": "ok"}).collect()}
    assert got == {1: (5, False), 2: (5, True), 3: (None, False), 4: (None, False)}


def test_keys_of_declared_tests_meet_once(spark, no_broadcast):
    a = spark.createDataFrame([(1, 1), (1, 9), (2, None)], "k long, p long")
    b = spark.createDataFrame([(1,)], "p long")
    tests = [Q.Test("unique", "a", "k"), Q.Test("not_null", "a", "p"), Q.Test("relationships", "a", "p", {"to": "b", "field": "p"}), Q.Test("relationships", "a", "k", {"to": "b", "field": "p"})]
    out = Q.run_tests(spark, {"a": a, "b": b}, tests)
    assert [(r.check_name, r.failing_rows) for r in out.orderBy("check_name").collect()] == [("not_null_a_p", 1), ("relationships_a_k", 1), ("relationships_a_p", 1), ("unique_a_k", 1)]
    assert not [line for line in _plan(out).splitlines() if "Exchange hashpartitioning(domain" in line and ", k#" in line and ", t#" in line]


def test_lines_of_a_file_are_numbered_without_dealing_them(spark, no_broadcast):
    path = scratch_path(spark, "numbered")
    spark.range(500).select(F.col("id").alias("a")).repartition(3).write.option("header", True).csv(path)
    df = I.read_csv_numbered(spark, path, ["a"], with_file=True)
    assert "SortMergeJoin" not in _plan(df)
    assert df.select("_file", "_row_number").distinct().count() == df.count() == 500


def test_checks_write_no_fact_for_its_sums(spark, sf_dir):
    from dwspark.plans import checks as CH

    w = Warehouse(spark, sf_dir)
    w.store = w.fx.store = Store(spark, scratch_path(spark, "sums"))
    CH.i34_singular_results(w)
    assert "int_ventas_lineas" not in w.__dict__ and "fct_inventario_mensual" not in w.__dict__
    assert "subquery" not in _plan(CH.i13_reconciliation(w.copy())).lower()
