"""Defect injection and the detection proof (A17, I35, I37), load log and run summary.

Ten defect cases are injected into the raw sources (one row each, cloned
from a template row with a new key); the staging tests and singular checks
then run on the clean and on the injected sources, and every case must raise
the failing count of its detector. Staging is derived from the raw rows, so raw
and fact still reconcile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.operators import quality as Q
from dwspark.plans import checks as CH
from dwspark.plans.warehouse import Warehouse
from dwspark.session import scratch_path
from dwspark.sources import audit as A
from dwspark.sources import loads as L
from dwspark.sources.fixtures import Fixtures
from dwspark.sources.store import Store

# Fixed defect cases: (n, staged table, template order, key column, field, value, type, fixed values, detector).
# Composite-key tables get a fixed new period instead of a new id, and products a new sku too.
DEFECT_CASES = [
    (1, "stg_cliente", ["id_cliente", "nit", "nombre_cliente"], None, "id_cliente", None, "llave_nula", {},
     "not_null_stg_cliente_id_cliente"),
    (2, "stg_producto", ["id_producto", "sku", "nombre_producto"], "id_producto", "precio_lista", "-12.50", "precio_negativo", {"sku": "QA990002"},
     "accepted_range_stg_producto_precio_lista"),
    (3, "stg_venta", ["id_venta", "fecha_venta", "id_cliente"], "id_venta", "id_cliente", 999999, "cliente_inexistente", {},
     "relationships_stg_venta_id_cliente"),
    (4, "stg_venta_detalle", ["id_detalle", "id_venta", "id_producto"], "id_detalle", "cantidad", 0, "cantidad_cero", {},
     "accepted_range_stg_venta_detalle_cantidad"),
    (5, "stg_venta_detalle", ["id_detalle", "id_venta", "id_producto"], "id_detalle", "descuento_pct", "1.20",
     "descuento_invalido", {}, "valid_percentage_stg_venta_detalle_descuento_pct"),
    (6, "stg_inventario", ["fecha_corte", "id_sucursal", "id_producto"], None, "stock_disponible", -5, "stock_negativo",
     {"fecha_corte": "2026-09-30"}, "accepted_range_stg_inventario_stock_disponible"),
    (7, "stg_inventario", ["fecha_corte", "id_sucursal", "id_producto"], None, "fecha_vencimiento", "2025-12-31",
     "vencimiento_anterior_al_corte", {"fecha_corte": "2026-09-30"}, "assert_vencimiento_posterior_al_corte"),
    (8, "stg_proveedores_precios", ["id_proveedor", "id_producto", "fecha_vigencia"], None, "costo_proveedor",
     None, "costo_nulo", {"fecha_vigencia": "2026-09-30"}, "not_null_stg_proveedores_precios_costo_proveedor"),
    (9, "stg_metas", ["anio_mes", "fecha_mes", "id_sucursal"], None, "meta_ventas", 0, "meta_cero",
     {"anio_mes": "2026-09", "fecha_mes": "2026-09-01"}, "accepted_range_stg_metas_meta_ventas"),
    (10, "stg_devoluciones", ["id_devolucion", "fecha_devolucion", "id_venta"], "id_devolucion", "cantidad_devuelta", 99,
     "devolucion_superior_a_venta", {}, "assert_devolucion_no_supera_vendido"),
]


# The raw source of each staged table, and its names of the columns that staging renames (None: made by staging).
RAW = {
    "stg_cliente": ("cliente", {"nombre_cliente": "nombre"}),
    "stg_producto": ("producto", {"nombre_producto": "nombre"}),
    "stg_venta": ("venta", {"fecha_venta": "fecha"}),
    "stg_venta_detalle": ("linea", {"descuento_pct": "descuento"}),
    "stg_inventario": ("inventario", {}),
    "stg_proveedores_precios": ("proveedor_precio", {}),
    "stg_metas": ("meta", {"anio_mes": "periodo", "fecha_mes": None}),
    "stg_devoluciones": ("devolucion", {"fecha_devolucion": "fecha", "cantidad_devuelta": "cantidad"}),
}
SOURCES = ["sucursal", "producto", "cliente", "venta", "linea", "promocion", "devolucion", "meta", "inventario", "proveedor_precio"]


class InjectedSources(Fixtures):
    """The sources with the defect rows; each source is the given one, so that one's defects don't reach another."""

    def __init__(self, fx: Fixtures):
        super().__init__(fx.t)
        frames = {name: getattr(fx, name)() for name in SOURCES}
        for n, staged, order, key, field, value, ctype, fixed, _ in DEFECT_CASES:
            name, renamed = RAW[staged]
            raw = lambda c: renamed.get(c, c)  # noqa: E731, B023
            fixed = {raw(c): v for c, v in fixed.items() if raw(c)}
            if key in ("id_detalle", "id_devolucion"):  # text keys: new key as text
                fixed, key = {**fixed, key: f"{990000 + n}"}, None
            frames[name] = L.inject_defect(frames[name], n, [raw(c) for c in order if raw(c)], key, raw(field), value, ctype, fixed)
        for name, df in frames.items():
            self.__dict__[name] = lambda df=df.drop("_source"): df


def injected_warehouse(w: Warehouse) -> Warehouse:
    """A warehouse over raw sources that carry the 10 defect rows: everything from staging on is derived from them."""
    injected = w.copy()
    injected.fx = InjectedSources(w.fx)
    return injected


def dirty(w: Warehouse) -> Warehouse:
    """The injected warehouse of ``w``, shared by its queries like ``w`` itself."""
    d = getattr(w, "_dirty", None)
    if d is None:
        d = w._dirty = injected_warehouse(w)
        d.store = w.store and Store(w.spark, scratch_path(w.spark, "dirty-star"))
    return d


#: Checks that find nothing in the given data, run again where there is something to find.
QUIET_CHECKS = [CH.i14_subtotal_consistency, CH.i19_calendar_gaps, CH.i20_raw_orphans, CH.i21_fact_orphans, CH.i22_facts_on_unknown, CH.i24_null_keys, CH.i25_duplicate_keys,
                CH.i27_dim_natural_keys_unique, CH.i28_one_unknown_member, CH.i29_sale_values, CH.i31_goals_positive]


def _on_defects(check):
    def run(w: Warehouse) -> DataFrame:
        return check(dirty(w))

    run.__name__, run.__doc__ = f"{check.__name__}_con_defectos", f"{check.__name__} over the sources with defects."
    return run


def _results(w: Warehouse) -> DataFrame:
    # a copy derives the columns that each check needs: no fact is written for two of its sums
    w = w.copy()
    staged = Q.run_tests(w.spark, CH.tables_of(w, CH.STAGING_TABLES), CH.staging_tests())
    return staged.unionByName(Q.run_checks(w.spark, CH.singular_checks(w)))


def a17_inject_defects(w: Warehouse) -> DataFrame:
    """The injected rows themselves, tagged with their case type.

    ``fila`` is the injected row's ordering columns (after the overrides)
    joined with '|': it shows which template row was cloned.
    """
    tables = {t: getattr(w, t) for t in {c[1] for c in DEFECT_CASES}}
    parts = []
    for n, table, order, key, field, value, ctype, fixed, _ in DEFECT_CASES:
        if key in ("id_detalle", "id_devolucion"):
            df2 = L.inject_defect(tables[table], n, order, None, field, value, ctype, {**fixed, key: f"{990000 + n}"})
        else:
            df2 = L.inject_defect(tables[table], n, order, key, field, value, ctype, fixed)
        row = df2.filter(F.col("_source").startswith("quality_case"))
        fila = F.concat_ws("|", *[F.col(c).cast("string") for c in order])
        parts.append(row.select(F.lit(n).alias("caso"), F.lit(table).alias("tabla"), F.lit(field).alias("campo"),
                                F.col(field).cast("string").alias("valor"), fila.alias("fila"),
                                F.col("_source").alias("_source")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def i37_defect_detection(w: Warehouse) -> DataFrame:
    """Per case: its detector's failing count before and after injection, and whether it rose."""
    before = _results(w).select("check_name", F.col("failing_rows").alias("antes"))
    after = _results(dirty(w)).select("check_name", "severity", F.col("failing_rows").alias("despues"))
    cases = w.spark.createDataFrame([(c[0], c[6], c[8]) for c in DEFECT_CASES], "caso int, tipo string, check_name string")
    j = cases.join(before, "check_name", "left").join(after, "check_name", "left")
    return j.select("caso", "tipo", "check_name", "severity", "antes", "despues",
                    (F.col("despues") > F.col("antes")).alias("detectado"))


def i37_failing_checks(w: Warehouse) -> DataFrame:
    """Checks whose failing count rose after injection (the run's new failures)."""
    before = _results(w).select("check_name", F.col("failing_rows").alias("antes"))
    after = _results(dirty(w))
    j = after.join(before, "check_name")
    return j.filter(F.col("failing_rows") > F.col("antes")).select("check_name", "check_type", "severity", "antes",
                                                                    F.col("failing_rows").alias("despues"))


def a15_run_summary(w: Warehouse) -> DataFrame:
    """Four real loads, tracked in the load log, + check results -> run summary."""
    batch, store = "lote-1", Store(w.spark, scratch_path(w.spark, "a15"))
    srcs = {"sucursal": w.fx.sucursal(), "producto": w.fx.producto(), "venta": w.fx.venta(), "venta_detalle": w.fx.linea()}
    for name, src in srcs.items():
        A.tracked_load(store, batch, name, src)
    checks = Q.run_checks(w.spark, CH.singular_checks(w))
    return L.run_summary(store.read(A.LOAD_LOG), checks, batch)


def i35_quarantine(w: Warehouse) -> DataFrame:
    """Rows that fail a staging test or singular check, each with all the tests it fails, in one write; read back by check."""
    path = scratch_path(w.spark, "quarantine")
    tables, checks = CH.tables_of(w, CH.STAGING_TABLES), CH.singular_checks(w)
    failed = {r["check_name"] for r in _results(w).filter("failing_rows > 0").collect()}
    Q.store_failures([t for t in CH.staging_tests() if t.check_name in failed], tables, path, checks=[c for c in checks if c.name in failed])
    return w.spark.read.parquet(path).groupBy("check_name").agg(F.count(F.lit(1)).alias("filas"))


def queries() -> dict:
    fns = [a17_inject_defects, i37_defect_detection, i37_failing_checks, a15_run_summary, i35_quarantine]
    return {f.__name__: f for f in [*fns, *map(_on_defects, QUIET_CHECKS)]}
