"""Operators on tiny literal frames: ties, NULL order keys, empty input, duplicates."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dwspark.operators import quality as Q
from dwspark.operators.aggregates import pivot_count, pivot_mean, value_counts
from dwspark.operators.joins import attribute_promotion, enrich_returns, overlaps, promotion_calendar
from dwspark.operators.scd import CURRENT, END, START, scd2_apply
from dwspark.operators.windows import dedup_first, is_min_per_key, period_shift, rank_flag
from dwspark.sources.loads import merge_rows

D = dt.date


def _promos(spark):
    return spark.createDataFrame([
        (1, "A", D(2020, 1, 1), D(2020, 1, 10), Decimal("0.10")),
        (2, "A", D(2020, 1, 5), D(2020, 1, 6), Decimal("0.20")),
        (3, "A", D(2020, 1, 5), D(2020, 1, 6), Decimal("0.20")),   # tie with 2: lowest id wins
        (4, "B", D(2020, 1, 10), D(2020, 1, 10), Decimal("0.05")),  # one-day promotion
    ], "id_promocion int, categoria string, fecha_inicio date, fecha_fin date, porcentaje_descuento decimal(5,4)")


def test_promotion_calendar_winner(spark):
    cal = {(r.categoria, r.fecha): r.id_promocion for r in promotion_calendar(_promos(spark)).collect()}
    assert cal[("A", D(2020, 1, 1))] == 1
    assert cal[("A", D(2020, 1, 5))] == 2
    assert cal[("A", D(2020, 1, 6))] == 2
    assert cal[("A", D(2020, 1, 10))] == 1
    assert cal[("B", D(2020, 1, 10))] == 4
    assert len(cal) == 11


def test_attribute_promotion_keeps_every_line(spark):
    lines = spark.createDataFrame([(1, "A", D(2020, 1, 5)), (2, "A", D(2020, 2, 1)), (3, "B", D(2020, 1, 10)), (4, None, None)],
                                  "id int, categoria string, fecha_venta date")
    out = {r.id: r.id_promocion for r in attribute_promotion(lines, _promos(spark)).collect()}
    assert out == {1: 2, 2: None, 3: 4, 4: None}


def test_overlaps(spark):
    o = {(r.id_promocion_a, r.id_promocion_b): (r.traslape_desde, r.traslape_hasta)
         for r in overlaps(_promos(spark), "categoria", "fecha_inicio", "fecha_fin", "id_promocion").collect()}
    assert o == {(1, 2): (D(2020, 1, 5), D(2020, 1, 6)), (1, 3): (D(2020, 1, 5), D(2020, 1, 6)),
                 (2, 3): (D(2020, 1, 5), D(2020, 1, 6))}


def test_overlaps_equals_all_pairs_brute_force(spark):
    """Random intervals incl. reversed ones, NULL keys and NULL starts: same pairs as checking every pair."""
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(200):
        s = D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))
        e = s + dt.timedelta(days=rnd.randint(-5, 20))
        rows.append((i, rnd.choice(["A", "B", None]), None if rnd.random() < 0.03 else s, e))
    df = spark.createDataFrame(rows, "id int, k string, s date, e date")
    got = sorted(tuple(r) for r in overlaps(df, "k", "s", "e", "id").collect())
    brute = sorted((a[0], b[0], a[1], max(a[2], b[2]), min(a[3], b[3]))
                   for a in rows for b in rows
                   if a[0] < b[0] and a[1] is not None and a[1] == b[1] and None not in (a[2], b[2])
                   and a[2] <= b[3] and b[2] <= a[3])
    assert got == brute and len(got) > 100


def test_dedup_first_and_rank_flag(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "x")], "k int, rn int, v string")
    assert {r.k: r.v for r in dedup_first(df, ["k"], ["rn"]).collect()} == {1: "a", 2: "x"}
    costs = spark.createDataFrame([(1, None), (1, Decimal("2")), (1, Decimal("2")), (2, None)], "p int, c decimal(5,0)")
    flags = sorted(((r.p, r.c, r.m) for r in rank_flag(costs, ["p"], F.col("c").asc_nulls_last(), "m").collect()),
                   key=lambda t: (t[0], t[1] is None, t[1] or 0))
    assert flags == [(1, Decimal("2"), True), (1, Decimal("2"), True), (1, None, False), (2, None, True)]


def test_period_shift_gap_and_year_boundary(spark):
    df = spark.createDataFrame([(D(2020, 11, 1), 10), (D(2021, 1, 1), 20), (D(2021, 2, 1), 30), (D(2021, 11, 1), 40)],
                               "m date, v int")
    prev = {r.m: r.p for r in period_shift(df, [], "m", "v", 1, "p").collect()}
    assert prev == {D(2020, 11, 1): None, D(2021, 1, 1): None, D(2021, 2, 1): 20, D(2021, 11, 1): None}
    yoy = {r.m: r.p for r in period_shift(df, [], "m", "v", 12, "p").collect()}
    assert yoy[D(2021, 11, 1)] == 10


def test_enrich_returns_collapses_repeated_products(spark):
    lines = spark.createDataFrame([
        (1, 10, D(2020, 1, 1), 7, 3, 2, Decimal("10.00")), (1, 10, D(2020, 1, 1), 7, 3, 3, Decimal("15.00")),
    ], "id_venta int, id_producto int, fecha_venta date, id_cliente int, id_sucursal int, cantidad int, monto_neto decimal(14,2)")
    rets = spark.createDataFrame([("r1", D(2020, 1, 4), 1, 10, 2, "x"), ("r2", D(2020, 1, 4), 9, 9, 1, "y")],
                                 "id_devolucion string, fecha_devolucion date, id_venta int, id_producto int, cantidad_devuelta int, motivo string")
    out = {r.id_devolucion: r for r in enrich_returns(rets, lines).collect()}
    assert out["r1"].cantidad_vendida == 5 and out["r1"].precio_neto_unitario == Decimal("5.0000")
    assert out["r1"].monto_devuelto == Decimal("10.00") and out["r1"].dias_desde_venta == 3
    assert out["r2"].cantidad_vendida is None and out["r2"].monto_devuelto is None


SCHEMA = "k string, price decimal(10,2), name string"


def test_scd2_cases(spark):
    first = spark.createDataFrame([("a", Decimal("1.00"), "A"), ("b", Decimal("2.00"), "B"), ("c", None, "C"),
                                   ("d", Decimal("4.00"), "D")], SCHEMA)
    h1 = scd2_apply(None, first, "k", ["price"], "2020-01-01", "sk")
    assert h1.count() == 4
    second = spark.createDataFrame([("a", Decimal("1.00"), "A"),   # unchanged
                                    ("b", Decimal("3.00"), "B"),   # changed
                                    ("c", Decimal("5.00"), "C"),   # from NULL
                                    ("d", None, "D"),              # to NULL
                                    ("e", Decimal("9.00"), "E")],  # new key
                                   SCHEMA)
    h2 = scd2_apply(h1, second, "k", ["price"], "2020-02-01", "sk")
    rows = sorted(((r.k, r[START], r[END], r[CURRENT], r.price) for r in h2.collect()), key=lambda t: (t[0], t[1]))
    assert rows == [
        ("a", D(2020, 1, 1), None, True, Decimal("1.00")),
        ("b", D(2020, 1, 1), D(2020, 2, 1), False, Decimal("2.00")),
        ("b", D(2020, 2, 1), None, True, Decimal("3.00")),
        ("c", D(2020, 1, 1), D(2020, 2, 1), False, None),
        ("c", D(2020, 2, 1), None, True, Decimal("5.00")),
        ("d", D(2020, 1, 1), D(2020, 2, 1), False, Decimal("4.00")),
        ("d", D(2020, 2, 1), None, True, None),
        ("e", D(2020, 2, 1), None, True, Decimal("9.00")),
    ]
    # same batch again: nothing changes
    h3 = scd2_apply(h2, second, "k", ["price"], "2020-03-01", "sk")
    assert sorted(map(str, h3.collect())) == sorted(map(str, h2.collect()))
    assert h2.select("sk").distinct().count() == 8


def test_merge_rows(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    inc = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    m = merge_rows(tgt, inc, "k")
    assert sorted(map(tuple, m.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, merge_rows(m, inc, "k").collect())) == [(1, "a"), (2, "B"), (3, "c")]  # repeated batch
    empty = spark.createDataFrame([], "k int, v string")
    assert sorted(map(tuple, merge_rows(m, empty, "k").collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_quality_rules_null_semantics(spark):
    df = spark.createDataFrame([(1, "x", Decimal("0.5")), (1, None, Decimal("1.5")), (None, "z", None), (2, "q", Decimal("-0.1"))],
                               "id int, cat string, pct decimal(5,2)")
    parent = spark.createDataFrame([(1,)], "id int")
    tables = {"t": df, "p": parent}
    tests = [
        Q.Test("unique", "t", "id"), Q.Test("not_null", "t", "id"),
        Q.Test("accepted_values", "t", "cat", {"values": ["x", "z"]}),
        Q.Test("accepted_range", "t", "pct", {"min_value": 0, "max_value": 1}),
        Q.Test("accepted_range", "t", "pct", {"min_value": 0, "inclusive": False}, name="range_excl"),
        Q.Test("valid_percentage", "t", "pct"),
        Q.Test("expression_is_true", "t", None, {"expression": "pct < 1"}, name="expr"),
        Q.Test("relationships", "t", "id", {"to": "p", "field": "id"}),
        Q.Test("unique_combination", "t", None, {"columns": ["id"]}),
    ]
    res = {r.check_name: r.failing_rows for r in Q.run_tests(spark, tables, tests).collect()}
    assert res["unique_t_id"] == 1                 # one duplicated key; NULL ignored
    assert res["not_null_t_id"] == 1
    assert res["accepted_values_t_cat"] == 1       # 'q'; NULL passes
    assert res["accepted_range_t_pct"] == 2        # 1.5 and -0.1; NULL passes
    assert res["range_excl"] == 1                  # -0.1 (0 itself would fail too)
    assert res["valid_percentage_t_pct"] == 2
    assert res["expr"] == 1                        # 1.5; NULL passes
    assert res["relationships_t_id"] == 1          # id 2; NULL child passes
    assert res["unique_combination_t_id"] == 1
    empty = spark.createDataFrame([], "id int, cat string, pct decimal(5,2)")
    res2 = Q.run_tests(spark, {"t": empty, "p": parent}, tests).collect()
    assert all(r.failing_rows == 0 and r.passed for r in res2)


def test_gate(spark):
    res = spark.createDataFrame([("a", "t", "error", 0, True), ("b", "t", "warn", 3, False)], Q.RESULT_SCHEMA)
    g = Q.gate(res).first()
    assert g.puede_publicar and g.advertencias == 1
    none = Q.gate(spark.createDataFrame([], Q.RESULT_SCHEMA)).first()
    assert not none.puede_publicar  # no checks ran -> not publishable


def test_pivots_and_value_counts(spark):
    df = spark.createDataFrame([("c1", "A", Decimal("1.00"), 1), ("c1", "A", Decimal("2.00"), 2), ("c1", "B", None, 3),
                                ("c2", "B", Decimal("5.00"), 4), (None, "A", Decimal("9.00"), 5)],
                               "city string, cat string, spend decimal(12,2), id int")
    pm = {r.city: (r.A, r.B) for r in pivot_mean(df, "city", "cat", "spend", ["A", "B"]).collect()}
    assert pm == {"c1": (Decimal("1.50"), Decimal("0.00")), "c2": (Decimal("0.00"), Decimal("5.00"))}
    pc = {r.city: (r.A, r.B) for r in pivot_count(df, "city", "cat", "id").collect()}
    assert pc == {"c1": (2, 1), "c2": (0, 1)}
    vc = {r.cat: (r.cantidad, r.proporcion) for r in value_counts(df, "cat").collect()}
    assert vc == {"A": (3, Decimal("0.6000")), "B": (2, Decimal("0.4000"))}
    # discovered pivot values are bounded like pivot(): too many -> an error, not a huge driver list
    old = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError, match="distinct values"):
            pivot_count(df, "city", "cat", "id")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", old)


def test_is_min_per_key_equals_rank_window(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (1, 3), (1, None), (2, None), (2, None), (None, 7), (None, 4), (3, 1)],
                               "p int, c int")
    a = sorted(map(str, rank_flag(df, ["p"], F.col("c").asc_nulls_last(), "m").collect()))
    b = sorted(map(str, is_min_per_key(df, ["p"], "c", "m").select("p", "c", "m").collect()))
    assert a == b


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_merge_batch_does_not_shuffle_target(spark):
    target = spark.range(0, 1000).selectExpr("id as k", "id * 2 as v")
    batch = spark.range(0, 10).selectExpr("id * 3 as k", "-1 as v")
    out = merge_rows(target, batch, "k")
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Exchange hashpartitioning" not in plan
    assert out.count() == 1000 and out.filter("v = -1").count() == 10


def test_overlaps_plan_has_no_cartesian_product(spark):
    plan = _plan(overlaps(_promos(spark), "categoria", "fecha_inicio", "fecha_fin", "id_promocion"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_promotion_attribution_is_one_broadcast_equi_join(spark):
    """The fact side is never shuffled or range-joined: one broadcast hash join on (category, day)."""
    lines = spark.range(0, 1000).selectExpr("id", "case when id % 2 = 0 then 'A' else 'B' end as categoria",
                                            "date_add(date'2020-01-01', cast(id % 20 as int)) as fecha_venta")
    plan = _plan(attribute_promotion(lines, _promos(spark)))
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan
