"""DuckDB SQL of the defect-detection proof: the checks over sources that carry the ten defect rows."""

from __future__ import annotations

import re

from oracle import ctes

# (case, source, order of the template, changed columns, type, check that must notice it)
DEFECTS = [
    (1, "cliente", "id_cliente, nit, nombre", {"id_cliente": "null::bigint"}, "llave_nula", "not_null_stg_cliente_id_cliente"),
    (2, "producto", "id_producto, sku, nombre", {"id_producto": "990002::bigint", "precio_lista": "(-12.50)::decimal(12,2)", "sku": "'QA990002'"}, "precio_negativo",
     "accepted_range_stg_producto_precio_lista"),
    (3, "venta", "id_venta, fecha, id_cliente", {"id_venta": "990003::bigint", "id_cliente": "999999::bigint"}, "cliente_inexistente", "relationships_stg_venta_id_cliente"),
    (4, "linea", "id_detalle, id_venta, id_producto", {"id_detalle": "'990004'", "cantidad": "0::int"}, "cantidad_cero", "accepted_range_stg_venta_detalle_cantidad"),
    (5, "linea", "id_detalle, id_venta, id_producto", {"id_detalle": "'990005'", "descuento": "1.2::decimal(5,4)"}, "descuento_invalido",
     "valid_percentage_stg_venta_detalle_descuento_pct"),
    (6, "inventario", "fecha_corte, id_sucursal, id_producto", {"fecha_corte": "date '2026-09-30'", "stock_disponible": "(-5)::int"}, "stock_negativo",
     "accepted_range_stg_inventario_stock_disponible"),
    (7, "inventario", "fecha_corte, id_sucursal, id_producto", {"fecha_corte": "date '2026-09-30'", "fecha_vencimiento": "date '2025-12-31'"}, "vencimiento_anterior_al_corte",
     "assert_vencimiento_posterior_al_corte"),
    (8, "proveedor_precio", "id_proveedor, id_producto, fecha_vigencia", {"fecha_vigencia": "date '2026-09-30'", "costo_proveedor": "null::decimal(12,2)"}, "costo_nulo",
     "not_null_stg_proveedores_precios_costo_proveedor"),
    (9, "meta", "periodo, id_sucursal", {"periodo": "'2026-09'", "meta_ventas": "0::decimal(14,2)"}, "meta_cero", "accepted_range_stg_metas_meta_ventas"),
    (10, "devolucion", "id_devolucion, fecha, id_venta", {"id_devolucion": "'990010'", "cantidad": "99::int"}, "devolucion_superior_a_venta", "assert_devolucion_no_supera_vendido"),
]


def _sources() -> list[tuple[str, str]]:
    """The sources as given under other names, then under their own with the defect rows added."""
    given = [(n, q) for n, q in ctes._CTES if n.startswith("fx_")]
    names = "|".join(n for n, _ in given)
    out = [(f"given_{n}", re.sub(rf"\b({names})\b", r"given_\1", q)) for n, q in given]
    for n, _ in given:
        parts = [f"select * from given_{n}"]
        for case, source, order, changes, _, _ in DEFECTS:
            if n == f"fx_{source}":
                new = ", ".join(f"{v} as {c}" for c, v in changes.items())
                by = ", ".join(f"{c} nulls last" for c in order.split(", "))
                parts.append(f"select * replace ({new}) from (select * from given_{n} order by {by} limit 1 offset {case})")
        out.append((n, " union all ".join(parts)))
    return out


def defect_queries(clean: dict[str, str]) -> dict[str, str]:
    """``clean``: the SQL of the checks over the given sources."""
    from oracle.checks_sql import check_queries

    kept = ctes._CTES
    try:
        ctes._CTES = _sources() + [(n, q) for n, q in kept if not n.startswith("fx_")]
        dirty = check_queries()
    finally:
        ctes._CTES = kept
    suites = ["i34_staging_results", "i34_singular_results"]
    before, after = (" union all ".join(f"(select * from ({q[s]}))" for s in suites) for q in (clean, dirty))
    compared = f"(select a.check_name, a.check_type, a.severity, b.failing_rows as antes, a.failing_rows as despues from ({after}) a join ({before}) b using (check_name))"
    cases = ", ".join(f"({n}, '{kind}', '{check}')" for n, _, _, _, kind, check in DEFECTS)
    quiet = "i14_subtotal_consistency i19_calendar_gaps i20_raw_orphans i21_fact_orphans i22_facts_on_unknown i24_null_keys i25_duplicate_keys i27_dim_natural_keys_unique " \
        "i28_one_unknown_member i29_sale_values i31_goals_positive"
    return {
        **{f"{n}_con_defectos": dirty[n] for n in quiet.split()},
        "i37_defect_detection": f"""
            select caso, tipo, check_name, severity, antes, despues, despues > antes as detectado
            from (values {cases}) c(caso, tipo, check_name) join {compared} using (check_name)""",
        "i37_failing_checks": f"select * from {compared} where despues > antes",
    }
