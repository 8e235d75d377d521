"""What the flight pages write grows with the flights, not with the cells of the cube."""

import os

import pytest
from pyspark.sql import functions as F

from dwspark.plans import flight_cube as FC
from dwspark.plans import flights as FL
from dwspark.plans.warehouse import Warehouse
from dwspark.session import scratch_path
from dwspark.sources.store import Store


@pytest.fixture(scope="module")
def shared(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    w.store = Store(spark, scratch_path(spark, "growth"))
    return w


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_a_row_of_the_cube_holds_a_word_not_a_run_of_thousands(shared):
    cube = FC.cube_of(shared)
    assert dict(cube.cells.dtypes)[FC.BITS] == "bigint"
    assert cube.cells.count() <= cube.fact.count()
    folder = f"{cube.store.root}/cubo_vuelos".removeprefix("file:")
    written = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))
    assert cube.cells.agg(F.sum(F.bit_count(FC.BITS))).first()[0] <= cube.fact.count()
    assert written < 4096 * cube.cells.count() / 4


def test_dimensions_and_fact_read_the_written_flights(shared):
    f = FL.flights_of(shared)
    for q in (FL.j15_top_destinations, FL.j18_delay_by_origin, FL.j16_gender_share):
        plan = _plan(q(f))
        assert "vuelos_limpios" in plan and "lineitem.parquet" not in plan
