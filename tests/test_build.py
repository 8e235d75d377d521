"""Production build: gate blocks on staging errors; materialised star gives the same query results."""

import pytest

from dwspark.plans import analytics as A
from dwspark.plans.build import GateFailed, build_warehouse, stage_gate
from dwspark.plans.warehouse import Warehouse


def test_gate_blocks_on_errors(spark, sf_dir, tmpdir_path):
    g = stage_gate(Warehouse(spark, sf_dir))
    # the role-mapped sources carry deliberate defects (NULL supplier costs, over-returns)
    assert not g["puede_publicar"] and g["errores"] > 0
    with pytest.raises(GateFailed):
        build_warehouse(spark, sf_dir, tmpdir_path)


def test_materialised_star_matches_lazy(spark, sf_dir, tmpdir_path):
    lazy = Warehouse(spark, sf_dir)
    built = build_warehouse(spark, sf_dir, tmpdir_path, enforce_gate=False)
    for q in (A.j01_monthly_sales, A.j07_returns_rollup, A.j08_inventory_status, A.j11_customer_type):
        a = sorted(map(str, q(lazy).collect()))
        b = sorted(map(str, q(built).collect()))
        assert a == b, q.__name__
    assert built.fct_ventas.count() == lazy.fct_ventas.count()
