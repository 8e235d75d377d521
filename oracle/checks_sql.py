"""Oracle SQL for the data-quality checks.

Declared tests are listed in ``oracle.declared``; singular and post-build
checks are written out here.
"""

from __future__ import annotations

from oracle.ctes import with_ctes
from oracle.declared import MARTS, STAGING, results_sql


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _results_union(items: list[tuple[str, str, str, str]]) -> str:
    """items: (name, type, severity, violations_sql) -> one result row each."""
    rows = [
        f"select {_lit(n)} as check_name, {_lit(ty)} as check_type, {_lit(sev)} as severity, "
        f"cast(count(*) as bigint) as failing_rows, count(*) = 0 as passed from ({sql}) v"
        for n, ty, sev, sql in items
    ]
    return "\nunion all\n".join(rows)


def _union(parts) -> str:
    return " union all ".join(parts)


_SOURCES = {"sucursal": "fx_sucursal", "producto": "fx_producto", "cliente": "fx_cliente", "venta": "fx_venta", "venta_detalle": "fx_linea",
            "inventario": "fx_inventario", "metas": "fx_meta", "promociones": "fx_promocion",
            "proveedores_precios": "fx_proveedor_precio", "devoluciones": "fx_devolucion"}
# (mart table, its source, members that the mart adds)
_LOADED = [("fct_ventas", "venta_detalle", 0), ("fct_inventario_mensual", "inventario", 0), ("fct_devoluciones", "devoluciones", 0),
           ("fct_metas_ventas", "metas", 0), ("fct_costos_proveedor", "proveedores_precios", 0), ("dim_cliente", "cliente", 1),
           ("dim_producto", "producto", 1), ("dim_sucursal", "sucursal", 1), ("dim_promocion", "promociones", 1)]
_SALE_KEYS = {"sk_fecha": "dim_fecha", "sk_cliente": "dim_cliente", "sk_producto": "dim_producto", "sk_sucursal": "dim_sucursal"}

# Raw keys by table: (relation, key). A key of several columns is joined by "/".
_INVENTORY_KEY = "concat_ws('/', fecha_corte, id_sucursal, id_producto)"
_OFFER_KEY = "concat_ws('/', id_proveedor, id_producto)"
_KEYS = {"cliente": ("fx_cliente", "id_cliente"), "producto": ("fx_producto", "id_producto"), "venta": ("fx_venta", "id_venta"),
         "venta_detalle": ("fx_linea", "id_detalle"), "devoluciones": ("fx_devolucion", "id_devolucion"), "inventario": ("fx_inventario", _INVENTORY_KEY)}
_NATURAL = {"dim_cliente": "id_cliente", "dim_producto": "id_producto", "dim_sucursal": "id_sucursal", "dim_fecha": "fecha"}
# (problem, relation, its key, columns that their own relation doesn't hold)
_ORPHANS = [
    ("venta_sin_cliente", "fx_venta", "id_venta", {"id_cliente": "fx_cliente"}),
    ("venta_sin_sucursal", "fx_venta", "id_venta", {"id_sucursal": "fx_sucursal"}),
    ("detalle_sin_venta_o_producto", "fx_linea", "id_detalle", {"id_venta": "fx_venta", "id_producto": "fx_producto"}),
    ("inventario_sin_producto_o_sucursal", "fx_inventario", _INVENTORY_KEY, {"id_producto": "fx_producto", "id_sucursal": "fx_sucursal"}),
    ("devolucion_sin_linea_vendida", "fx_devolucion", "id_devolucion", {"(id_venta, id_producto)": "fx_linea"}),
    ("proveedor_producto_inexistente", "fx_proveedor_precio", _OFFER_KEY, {"id_producto": "fx_producto"}),
]
_MEASURES = {"venta_detalle": ("fx_linea", "id_detalle", "cantidad precio_unitario subtotal"), "proveedores_precios": ("fx_proveedor_precio", _OFFER_KEY, "costo_proveedor"),
             "inventario_bodega": ("fx_inventario", _INVENTORY_KEY, "stock_disponible")}


def _outside(columns: dict[str, str]) -> str:
    """A row of which a column (or tuple) isn't among the same of its relation; NULL is never among them."""
    return " or ".join(f"coalesce({c} not in (select {c.strip('()')} from {r} where {c.strip('()').split(',')[0]} is not null), true)" for c, r in columns.items())


def _repeated(keys: dict[str, tuple[str, str]], label: str, more: str = "") -> str:
    """Keys of all tables as one list, those in it more than once."""
    listed = _union(f"select '{t}' as {label}, cast({k} as varchar) as llave from {r}" for t, (r, k) in keys.items())
    return f"select {label}, llave{more} from ({listed}) group by {label}, llave having count(*) > 1"


SINGULAR = {
    "i10_return_above_sold": """
        from (select id_devolucion, id_venta, id_producto, cantidad_devuelta,
                     (select cast(sum(x.cantidad) as bigint) from stg_venta_detalle x
                      where x.id_venta = r.id_venta and x.id_producto = r.id_producto) as cantidad_vendida
              from stg_devoluciones r)
        select * where coalesce(cantidad_vendida, -1) < cantidad_devuelta""",
    "i11_return_before_sale": """
        select d.id_devolucion, d.id_venta, v.fecha_venta, d.fecha_devolucion
        from stg_devoluciones d join stg_venta v on v.id_venta = d.id_venta where d.fecha_devolucion < v.fecha_venta""",
    "i12_promotion_overlaps": """
        select a.id_promocion as promocion_a, b.id_promocion as promocion_b, a.categoria,
               greatest(a.fecha_inicio, b.fecha_inicio) as traslape_desde, least(a.fecha_fin, b.fecha_fin) as traslape_hasta
        from stg_promociones a join stg_promociones b on a.categoria = b.categoria and a.id_promocion < b.id_promocion
         and a.fecha_inicio <= b.fecha_fin and b.fecha_inicio <= a.fecha_fin""",
    "i13_reconciliation": """
        select reconciliacion, filas_raw, filas_fct, total_raw, total_fct,
               (filas_raw is not distinct from filas_fct) and (total_raw is not distinct from total_fct) as cuadra
        from (
          select 'ventas' as reconciliacion, (select count(*) from fx_linea) as filas_raw, (select count(*) from fct_ventas) as filas_fct,
                 (select cast(sum(subtotal) as decimal(38,2)) from fx_linea) as total_raw,
                 (select cast(sum(monto_neto) as decimal(38,2)) from fct_ventas) as total_fct
          union all
          select 'inventario', (select count(*) from fx_inventario), (select count(*) from fct_inventario_mensual),
                 (select cast(sum(stock_disponible) as decimal(38,2)) from fx_inventario),
                 (select cast(sum(stock_disponible) as decimal(38,2)) from fct_inventario_mensual))""",
    "i14_subtotal_consistency": """
        select id_detalle, cantidad, precio_unitario, descuento_pct, monto_neto,
               round(cantidad * precio_unitario * (1 - descuento_pct), 2) as monto_esperado
        from stg_venta_detalle where abs(monto_neto - round(cantidad * precio_unitario * (1 - descuento_pct), 2)) > 0.01""",
    "i15_expiry_before_cutoff": """
        select fecha_corte, id_sucursal, id_producto, lote, fecha_vencimiento from stg_inventario where fecha_vencimiento < fecha_corte""",
    "i16_sale_before_signup": """
        select v.id_venta, v.fecha_venta, c.id_cliente, c.fecha_alta
        from stg_venta v join stg_cliente c on c.id_cliente = v.id_cliente where v.fecha_venta < c.fecha_alta""",
}

POST_BUILD = {
    "i17_raw_not_empty": _union(f"select '{t}' as tabla, count(*) as filas from {r}" for t, r in {**_SOURCES, "categoria": "stg_categoria", "marca": "stg_marca"}.items()),
    "i18_counts_raw_vs_marts": _union(
        f"select '{m}' as entidad, (select count(*) + {more} from {_SOURCES[t]}) as filas_raw, count(*) as filas_marts from {m}"
        for m, t, more in _LOADED),
    "i19_calendar_gaps": """
        select 'fecha fuera de dim_fecha' as problema, fecha from (
          (select fecha from fx_venta union all select unnest([fecha_corte, fecha_vencimiento]) from fx_inventario)
          except select fecha from dim_fecha) sin_dia""",
    "i20_raw_orphans": _union(f"select '{problem}' as check_name, cast({key} as varchar) as llave from {r} where {_outside(cols)}" for problem, r, key, cols in _ORPHANS),
    "i21_fact_orphans": "select id_detalle from fct_ventas where " + " or ".join(
        f"{k} not in (select {k} from {d})" for k, d in _SALE_KEYS.items()),
    "i22_facts_on_unknown": _union(
        f"select '{f}' as hecho, filas from (select count(*) as filas from {f} where list_has_any([{keys}], ['-1', md5('-1')])) where filas > 0"
        for f, keys in (("fct_ventas", "sk_cliente, sk_producto, sk_sucursal, cast(sk_fecha as varchar)"),
                        ("fct_inventario_mensual", "sk_producto, sk_sucursal, cast(sk_fecha_corte as varchar)"))),
    "i24_null_keys": _union(
        f"select '{t}.{k}' as columna, nulos from (select count(*) - count({k}) as nulos from {r}) where nulos > 0" for t, (r, k) in _KEYS.items() if t != "inventario"),
    "i25_duplicate_keys": _repeated({t: k for t, k in _KEYS.items() if t != "devoluciones"}, "tabla", ", count(*) as veces"),
    "i26_null_measures": _union(
        f"select '{t}' as tabla, {key} as llave from {r} where {' or '.join(f'{m} is null' for m in measures.split())}" for t, (r, key, measures) in _MEASURES.items()),
    "i27_dim_natural_keys_unique": _repeated({d: (f"(select * from {d} where {k} is not null)", k) for d, k in _NATURAL.items()}, "dimension"),
    "i28_one_unknown_member": _union(
        f"select '{d}' as dimension, n as miembros from (select coalesce(sum(cast({k} = -1 as int)), 0)::bigint as n from {d}) where n <> 1"
        for d, k in {**{d: k for d, k in _NATURAL.items() if d != "dim_fecha"}, "dim_promocion": "id_promocion", "dim_fecha": "sk_fecha"}.items()),
    "i29_sale_values": """
        select id_detalle, cantidad, precio_unitario, descuento_pct, monto_neto
        from (select *, [cantidad <= 0, precio_unitario < 0, descuento_pct < 0, descuento_pct > 1, monto_bruto <> monto_neto + monto_descuento,
                         abs(round(cantidad * precio_unitario * (1 - descuento_pct), 2) - monto_neto) > 0.01] as roto
              from fct_ventas) where list_contains(roto, true)""",
    "i30_stock_rules": """
        select sk_inventario, stock_disponible, dias_para_vencer
        from (select *, [dias_para_vencer < 0, stock_maximo < stock_minimo, stock_disponible < 0] as roto from fct_inventario_mensual)
        where list_contains(roto, true)""",
    "i31_goals_positive": """
        select anio_mes, sk_sucursal, meta_ventas from fct_metas_ventas where meta_ventas <= 0 or meta_unidades <= 0""",
    "i32_over_stock": """
        select sk_inventario, stock_disponible, stock_maximo from fct_inventario_mensual where es_sobre_maximo""",
    "i33_source_vs_raw": _union(
        f"select '{t}' as tabla, count(*) as filas_origen, count(*) as filas_raw, cast(0 as bigint) as failing_rows from {_SOURCES[t]}"
        for t in ("sucursal", "producto", "cliente", "venta", "venta_detalle", "inventario", "devoluciones")),
    "i10_mart_return_above_sold": """
        select id_devolucion, cantidad_devuelta, cantidad_vendida
        from (select id_devolucion, cantidad_devuelta, (select cast(sum(cantidad) as bigint) from fct_ventas sold
                      where sold.id_venta = r.id_venta and sold.sk_producto = r.sk_producto) as cantidad_vendida
              from fct_devoluciones r) where cantidad_vendida < cantidad_devuelta""",
    "i11_mart_return_before_sale": """
        select id_devolucion, dias_desde_venta from fct_devoluciones where dias_desde_venta < 0""",
    "i16_mart_sale_before_signup": """
        select distinct id_venta, fecha_venta, fecha_alta from int_ventas_lineas join stg_cliente using (id_cliente) where fecha_alta > fecha_venta""",
}

# name, type, severity, violations key (+ optional filter on that query)
SINGULAR_RESULTS = [
    ("assert_devolucion_no_supera_vendido", "singular", "error", "i10_return_above_sold", None),
    ("assert_devolucion_posterior_a_venta", "singular", "error", "i11_return_before_sale", None),
    ("assert_promociones_sin_traslape", "singular", "warn", "i12_promotion_overlaps", None),
    ("assert_reconciliacion_raw_vs_fct", "singular", "error", "i13_reconciliation", "not cuadra"),
    ("assert_subtotal_consistente", "singular", "error", "i14_subtotal_consistency", None),
    ("assert_vencimiento_posterior_al_corte", "singular", "error", "i15_expiry_before_cutoff", None),
    ("assert_venta_posterior_alta_cliente", "singular", "warn", "i16_sale_before_signup", None),
]
# violations that no query of their own shows
EXTRA = {
    "fks": f"select * from ({results_sql(MARTS, 'relationships')})",
    "montos": """select id_detalle from fct_ventas where monto_bruto - monto_neto <> monto_descuento
                 or abs(round(cantidad * precio_unitario * (1 - descuento_pct), 2) - monto_neto) > 0.01""",
    "valores": "select id_detalle from fct_ventas where least(cantidad - 1, precio_unitario, descuento_pct, 1 - descuento_pct) < 0",
}
_E, _W = "error", "warn"
POST_BUILD_RESULTS = [
    *[(f"reconciliacion_origen_raw_{t}", "conteo", _E, "i33_source_vs_raw", f"tabla = '{t}' and failing_rows > 0")
      for t in ("sucursal", "producto", "cliente", "venta", "venta_detalle", "inventario", "devoluciones")],
    ("raw_tablas_con_datos", "conteo", _E, "i17_raw_not_empty", "filas = 0"),
    ("reconciliacion_conteos_raw_vs_marts", "conteo", _E, "i18_counts_raw_vs_marts", "filas_raw <> filas_marts"),
    *[(f"reconciliacion_{name}", "conteo", _E, "i13_reconciliation", f"not cuadra and reconciliacion = '{which}'")
      for name, which in (("montos_ventas", "ventas"), ("stock_inventario", "inventario"))],
    ("dim_fecha_cubre_hechos", "conteo", _E, "i19_calendar_gaps", None),
    *[(f"raw_{problem}", "integridad", _E, "i20_raw_orphans", f"check_name = '{problem}'") for problem, *_ in _ORPHANS],
    ("marts_fct_ventas_huerfanos", "integridad", _E, "i21_fact_orphans", None),
    ("marts_hechos_en_miembro_desconocido", "integridad", _W, "i22_facts_on_unknown", None),
    ("marts_relaciones_declaradas", "integridad", _E, "fks", "not passed"),
    ("raw_llaves_nulas", "nulos_unicidad", _E, "i24_null_keys", None),
    ("raw_llaves_duplicadas", "nulos_unicidad", _E, "i25_duplicate_keys", None),
    ("raw_medidas_nulas", "nulos_unicidad", _E, "i26_null_measures", None),
    ("marts_llaves_naturales_unicas", "nulos_unicidad", _E, "i27_dim_natural_keys_unique", None),
    ("marts_un_solo_miembro_desconocido", "nulos_unicidad", _E, "i28_one_unknown_member", None),
    ("ventas_montos_consistentes", "negocio", _E, "montos", None),
    ("ventas_valores_validos", "negocio", _E, "valores", None),
    ("devoluciones_no_superan_venta", "negocio", _E, "i10_mart_return_above_sold", None),
    ("devoluciones_posteriores_a_venta", "negocio", _E, "i11_mart_return_before_sale", None),
    ("inventario_sin_negativos_ni_vencidos", "negocio", _E, "i30_stock_rules", None),
    ("metas_positivas", "negocio", _E, "i31_goals_positive", None),
    ("inventario_sobre_stock", "negocio", _W, "i32_over_stock", None),
    ("ventas_antes_del_alta_cliente", "negocio", _W, "i16_mart_sale_before_signup", None),
]


def _from_listing(spec) -> str:
    out = []
    for name, ty, sev, key, flt in spec:
        base = {**SINGULAR, **POST_BUILD, **EXTRA}[key]
        sql = f"select * from ({base}) x where {flt}" if flt else base
        out.append((name, ty, sev, sql))
    return with_ctes(_results_union(out))


def check_queries() -> dict[str, str]:
    out = {k: with_ctes(v) for k, v in {**SINGULAR, **POST_BUILD}.items()}
    out["i34_staging_results"] = with_ctes(results_sql(STAGING))
    out["i34_mart_results"] = with_ctes(results_sql(MARTS))
    out["i23_declared_fks"] = with_ctes(results_sql(MARTS, "relationships"))
    out["i34_singular_results"] = _from_listing(SINGULAR_RESULTS)
    out["i34_post_build_results"] = _from_listing(POST_BUILD_RESULTS)
    gate_src = f"({out['i34_staging_results']}) union all ({out['i34_singular_results']})"
    out["i36_stage_gate"] = f"""
        select count(*) filter (where severity = 'error' and not passed) as errores,
               count(*) filter (where severity = 'warn' and not passed) as advertencias,
               count(*) as pruebas,
               count(*) filter (where severity = 'error' and not passed) = 0 and count(*) > 0 as puede_publicar
        from ({gate_src}) r"""
    return out
