"""Name -> query callable ``(spark, sf_dir) -> DataFrame`` for every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dwspark.plans import analytics as A
from dwspark.plans.warehouse import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]


def _wh(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Warehouse.of(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = getattr(fn, "__doc__", None)
    return run


def _frame(attr: str) -> QueryFn:
    def get(w: Warehouse) -> DataFrame:
        df = getattr(w, attr)
        return df.drop(*[c for c in df.columns if c.startswith("__")])

    get.__name__ = attr
    return _wh(get)


def warehouse_queries() -> dict[str, QueryFn]:
    return {
        "h01_dim_fecha": _frame("dim_fecha"),
        "h02_dim_sucursal": _frame("dim_sucursal"),
        "h03_dim_producto": _frame("dim_producto"),
        "h04_dim_cliente": _frame("dim_cliente"),
        "h05_dim_proveedor": _frame("dim_proveedor"),
        "h06_dim_promocion": _frame("dim_promocion"),
        "h07_dim_condicion_venta": _frame("dim_condicion_venta"),
        "h08_int_ventas_lineas": _frame("int_ventas_lineas"),
        "h09_fct_ventas": _frame("fct_ventas"),
        "h10_fct_devoluciones": _frame("fct_devoluciones"),
        "h11_fct_inventario_mensual": _frame("fct_inventario_mensual"),
        "h12_fct_metas_ventas": _frame("fct_metas_ventas"),
        "h13_fct_costos_proveedor": _frame("fct_costos_proveedor"),
        "h14_mart_cumplimiento_metas": _frame("mart_cumplimiento_metas"),
        "h15_mart_alertas_inventario": _frame("mart_alertas_inventario"),
    }


def analytics_queries() -> dict[str, QueryFn]:
    fns = [
        A.j01_monthly_sales, A.j02_category_brand, A.j03_top_products, A.j04_branch_goals, A.j05_channel_payment,
        A.j06_promotion_effect, A.j07_returns_rollup, A.j08_inventory_status, A.j09_reorder, A.j10_inventory_value,
        A.j11_customer_type, A.j12_cheapest_supplier, A.j13_weekday, A.j21_kpis, A.j22_monthly, A.j23_by_category,
        A.j24_actual_vs_goal, A.j25_attainment_by_branch, A.j26_returns_by_reason, A.j27_top_products_by_name,
        A.j28_inventory_alerts, A.d05_promotion_attribution,
    ]
    return {f.__name__: _wh(f) for f in fns}


def check_queries() -> dict[str, QueryFn]:
    from dwspark.plans import checks as C

    fns = [
        C.i10_return_above_sold, C.i11_return_before_sale, C.i12_promotion_overlaps, C.i13_reconciliation,
        C.i14_subtotal_consistency, C.i15_expiry_before_cutoff, C.i16_sale_before_signup, C.i17_raw_not_empty,
        C.i18_counts_raw_vs_marts, C.i19_calendar_gaps, C.i20_raw_orphans, C.i21_fact_orphans, C.i22_facts_on_unknown,
        C.i23_declared_fks, C.i24_null_keys, C.i25_duplicate_keys, C.i26_null_measures, C.i27_dim_natural_keys_unique,
        C.i28_one_unknown_member, C.i29_sale_values, C.i30_stock_rules, C.i31_goals_positive, C.i32_over_stock, C.i33_source_vs_raw,
        C.i10_mart_return_above_sold, C.i11_mart_return_before_sale, C.i16_mart_sale_before_signup,
        C.i34_staging_results, C.i34_mart_results, C.i34_singular_results, C.i34_post_build_results, C.i36_stage_gate,
    ]
    return {f.__name__: _wh(f) for f in fns}


def flight_queries() -> dict[str, QueryFn]:
    from dwspark.plans import flights as FL

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(FL.flights_of(Warehouse.of(spark, sf_dir)))

        run.__name__ = fn.__name__
        return run

    return {name: wrap(fn) for name, fn in FL.queries().items()}


def _wrap_with(ctx, fns: dict) -> dict[str, QueryFn]:
    """Adapt ``fn(context)`` callables; ``ctx(warehouse)`` gives the shared context object."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ctx(Warehouse.of(spark, sf_dir)))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {name: wrap(fn) for name, fn in fns.items()}


def customer_queries() -> dict[str, QueryFn]:
    from dwspark.plans import customers as CU

    return _wrap_with(CU.customers_of, CU.queries())


def retail_queries() -> dict[str, QueryFn]:
    from dwspark.plans import retail as RT

    return _wrap_with(RT.retail_of, RT.queries())


def incremental_queries() -> dict[str, QueryFn]:
    from dwspark.plans import incremental as INC

    return _wrap_with(INC.incremental_of, INC.queries())


def csv_queries() -> dict[str, QueryFn]:
    from dwspark.plans import csv_staging as CSV

    return _wrap_with(CSV.csv_of, CSV.queries())


def cube_queries() -> dict[str, QueryFn]:
    from dwspark.plans import flight_cube as FC

    return _wrap_with(FC.cube_of, FC.queries())


def run_queries() -> dict[str, QueryFn]:
    from dwspark.plans import run as RUN

    return _wrap_with(RUN.runs_of, RUN.queries())


def defect_queries() -> dict[str, QueryFn]:
    from dwspark.plans import defects as DF

    return _wrap_with(lambda w: w, DF.queries())


def staging_queries() -> dict[str, QueryFn]:
    """The ten staged sources."""
    names = ["stg_sucursal", "stg_categoria", "stg_marca", "stg_producto", "stg_cliente", "stg_venta", "stg_venta_detalle", "stg_promociones",
             "stg_devoluciones", "stg_metas", "stg_inventario", "stg_proveedores_precios"]
    return {f"h00_{n}": _frame(n) for n in names}


def all_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    out.update(warehouse_queries())
    out.update(analytics_queries())
    out.update(check_queries())
    out.update(flight_queries())
    out.update(customer_queries())
    out.update(retail_queries())
    out.update(incremental_queries())
    out.update(defect_queries())
    out.update(run_queries())
    out.update(cube_queries())
    out.update(csv_queries())
    out.update(staging_queries())
    return out
