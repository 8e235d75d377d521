"""The oracle's own list of declared tests, and their SQL.

One line a table: rules separated by `;`, each a word and its columns.
  key c: unique and not null          nn c ...: not null
  fk c>table.field: not null and in the other table (in: the second alone)
  min c n: not null and at least n    above c n: not null and more than n    from c n: at least n
  pct c: between 0 and 1              combo a+b: unique together
  known c / known! c: not the unknown member, a warning / an error
  list c NAME: one of a list          expr NAME condition: true; expr? is a warning
"""

from __future__ import annotations

LISTS = {
    "CLIENTE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "CANAL": ["Tienda", "Mayorista", "Televenta", "Web"],
    "PAGO": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "ESTADO": ["COMPLETADA", "ANULADA", "PENDIENTE"],
    "MOTIVO": ["Vencimiento cercano", "Error de despacho", "Cliente desistió", "Producto dañado", "Empaque defectuoso"],
    "STOCK": ["SIN STOCK", "BAJO MÍNIMO", "SOBRE STOCK", "OK"],
}

STAGING = """
stg_sucursal: key id_sucursal; nn nombre_sucursal
stg_categoria: key id_categoria; key categoria
stg_marca: key id_marca; key marca
stg_producto: key id_producto; key sku; fk categoria>stg_categoria.categoria; fk marca>stg_marca.marca; min costo_base 0; min precio_lista 0; expr? precio_ge_costo precio_lista >= costo_base
stg_cliente: key id_cliente; nn nombre_cliente fecha_alta; list tipo_cliente CLIENTE
stg_venta: key id_venta; nn fecha_venta; fk id_cliente>stg_cliente.id_cliente; fk id_sucursal>stg_sucursal.id_sucursal; list canal CANAL; list metodo_pago PAGO; list estado_venta ESTADO
stg_venta_detalle: key id_detalle; fk id_venta>stg_venta.id_venta; fk id_producto>stg_producto.id_producto; min cantidad 1; min precio_unitario 0; nn descuento_pct; pct descuento_pct; min monto_neto 0
stg_inventario: combo fecha_corte+id_sucursal+id_producto; nn fecha_corte fecha_vencimiento; fk id_sucursal>stg_sucursal.id_sucursal; fk id_producto>stg_producto.id_producto; min stock_disponible 0; min stock_minimo 0; expr min_le_max stock_minimo <= stock_maximo; expr? stock_le_max stock_disponible <= stock_maximo
stg_metas: combo anio_mes+id_sucursal; nn fecha_mes; fk id_sucursal>stg_sucursal.id_sucursal; above meta_ventas 0; above meta_unidades 0
stg_promociones: key id_promocion; fk categoria>stg_producto.categoria; nn porcentaje_descuento; pct porcentaje_descuento; expr inicio_le_fin fecha_inicio <= fecha_fin
stg_proveedores_precios: combo id_proveedor+id_producto+fecha_vigencia; nn id_proveedor; fk id_producto>stg_producto.id_producto; min costo_proveedor 0; from plazo_dias 0
stg_devoluciones: key id_devolucion; fk id_venta>stg_venta.id_venta; fk id_producto>stg_producto.id_producto; min cantidad_devuelta 1; list motivo MOTIVO
"""

MARTS = """
dim_fecha: key sk_fecha
dim_sucursal: key sk_sucursal
dim_producto: key sk_producto
dim_cliente: key sk_cliente
dim_proveedor: key sk_proveedor
dim_promocion: key sk_promocion; pct porcentaje_descuento
dim_condicion_venta: key sk_condicion_venta
fct_ventas: key id_detalle; fk sk_fecha>dim_fecha.sk_fecha; fk sk_cliente>dim_cliente.sk_cliente; fk sk_producto>dim_producto.sk_producto; fk sk_sucursal>dim_sucursal.sk_sucursal; fk sk_condicion_venta>dim_condicion_venta.sk_condicion_venta; fk sk_promocion>dim_promocion.sk_promocion; known! sk_fecha; known sk_cliente sk_producto sk_sucursal; pct descuento_pct
fct_devoluciones: key id_devolucion; fk sk_fecha>dim_fecha.sk_fecha; fk sk_fecha_venta>dim_fecha.sk_fecha; fk sk_producto>dim_producto.sk_producto; fk sk_cliente>dim_cliente.sk_cliente; fk sk_sucursal>dim_sucursal.sk_sucursal; known! sk_fecha sk_fecha_venta; known sk_producto sk_cliente sk_sucursal
fct_inventario_mensual: key sk_inventario; fk sk_fecha_corte>dim_fecha.sk_fecha; fk sk_fecha_vencimiento>dim_fecha.sk_fecha; fk sk_sucursal>dim_sucursal.sk_sucursal; fk sk_producto>dim_producto.sk_producto; known! sk_fecha_corte sk_fecha_vencimiento; known sk_sucursal sk_producto
fct_metas_ventas: combo anio_mes+sk_sucursal; fk sk_fecha_mes>dim_fecha.sk_fecha; fk sk_sucursal>dim_sucursal.sk_sucursal; known! sk_fecha_mes; known sk_sucursal
fct_costos_proveedor: combo sk_proveedor+sk_producto+sk_fecha_vigencia; fk sk_proveedor>dim_proveedor.sk_proveedor; fk sk_producto>dim_producto.sk_producto; fk sk_fecha_vigencia>dim_fecha.sk_fecha; known sk_producto; known! sk_fecha_vigencia
mart_alertas_inventario: list estado_stock STOCK
mart_cumplimiento_metas: combo anio_mes+id_sucursal
"""


def _checks(table: str, rule: str):
    """(kind, column or name, severity, condition that a row or group fails by; groups of columns for set rules)."""
    word, rest = rule.split(maxsplit=1)
    first, _, more = rest.partition(" ")
    if word in ("key", "nn"):
        for c in rest.split():
            yield "not_null", c, "error", f"{c} is null"
            if word == "key":
                yield "unique", c, "error", [c]
    elif word in ("fk", "in"):
        column, parent = rest.split(">")
        to, field = parent.split(".")
        yield "not_null", column, "error", f"{column} is null"
        yield "relationships", column, "error", f"{column} is not null and {column} not in (select {field} from {to} where {field} is not null)"
    elif word in ("min", "above", "from"):
        if word != "from":
            yield "not_null", first, "error", f"{first} is null"
        yield "accepted_range", first, "error", f"{first} {'<=' if word == 'above' else '<'} {more}"
    elif word == "pct":
        yield "valid_percentage", rest, "error", f"{rest} < 0 or {rest} > 1"
    elif word == "combo":
        yield "unique_combination", rest.replace("+", "_"), "error", rest.split("+")
    elif word.startswith("known"):
        for c in rest.split():
            yield "not_unknown", c, "error" if word == "known!" else "warn", f"cast({c} as varchar) in ('-1', md5('-1'))"
    elif word == "list":
        values = ", ".join(f"'{v}'" for v in LISTS[more])
        yield "accepted_values", first, "error", f"{first} not in ({values})"
    else:
        yield "expression_is_true", first, "warn" if word == "expr?" else "error", f"not ({more})"


def results_sql(spec: str, kind: str | None = None) -> str:
    """One result row a test: check_name, check_type, severity, failing_rows, passed."""
    parts = []
    for line in spec.strip().splitlines():
        table, rules = line.split(": ", 1)
        for rule in rules.split("; "):
            for k, name, severity, fails in _checks(table, rule):
                if kind and k != kind:
                    continue
                if isinstance(fails, list):
                    held = " and ".join(f"{c} is not null" for c in fails) if k == "unique" else "true"
                    n = f"(select count(*) from (select 1 from {table} where {held} group by {', '.join(fails)} having count(*) > 1))"
                else:
                    n = f"(select count(*) from {table} where {fails})"
                parts.append(f"select '{k}_{table}_{name}', '{k}', '{severity}', {n}")
    listed = "\nunion all ".join(parts)
    return f"select check_name, check_type, severity, cast(n as bigint) as failing_rows, n = 0 as passed from ({listed}) t(check_name, check_type, severity, n)"
