"""Bitmaps merge to exact distinct counts; slicers prune the written partitions."""

import itertools

import pytest
from dwspark.plans import flight_cube as FC
from dwspark.plans.warehouse import Warehouse
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def cube(spark, sf_dir):
    return FC.cube_of(Warehouse(spark, sf_dir))


def test_every_grouping_merges_to_the_exact_distinct_count(cube):
    for n in range(len(FC.CUBE_KEYS) + 1):
        for by in itertools.combinations(FC.CUBE_KEYS, n):
            want = cube.fact.groupBy(*by).agg(F.countDistinct("id_pasajero").alias("p"), F.count(F.lit(1)).alias("n")).collect()
            got = cube.measures(cube.cells, list(by)).select(*by, "pasajeros_distintos", "total_vuelos").collect()
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want)))


def test_passenger_numbers_are_distinct_and_span_runs(cube):
    n = cube.passengers.agg(F.count(F.lit(1)), F.countDistinct("numero"), F.countDistinct("id_pasajero")).first()
    assert n[0] == n[1] == n[2]


def test_a_period_prunes_the_partitions_of_fact_and_cube(cube):
    for rows in (cube.fact, cube.cells):
        out = cube.sliced(rows.select("*"), FC.Slicers(anio=1996))
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        assert "dynamicpruning" in plan.lower(), plan
        assert {r[0] // 100 for r in out.select(FC.MONTH).distinct().collect()} == {1996}


def test_open_slicers_filter_nothing(cube):
    assert cube.sliced(cube.fact, FC.Slicers()).count() == cube.fact.count()
    none = cube.measures(cube.sliced(cube.cells, FC.Slicers(anio=1800)), []).first()
    assert none["total_vuelos"] == 0 and none["pasajeros_distintos"] == 0 and none["ingresos_totales_usd"] is None
