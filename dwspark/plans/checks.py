"""The warehouse's check suites (I01-I33, I37) declared as data + named violation frames."""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.functions.keys import packed, sk_unknown, unpacked
from dwspark.operators import quality as Q
from dwspark.operators.joins import overlaps
from dwspark.operators.quality import ERROR, WARN, Check, Test
from dwspark.plans.warehouse import Warehouse
from dwspark.session import scratch_path
from dwspark.sources import fixtures as FX
from dwspark.sources import loads as L

# Fixed accepted values of the role-mapped sources.
CUSTOMER_TYPES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PAYMENT_METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SALE_STATUSES = ["COMPLETADA", "ANULADA", "PENDIENTE"]
STOCK_STATUSES = ["SIN STOCK", "BAJO MÍNIMO", "SOBRE STOCK", "OK"]


def _nn(table: str, *cols: str) -> list[Test]:
    return [Test("not_null", table, c) for c in cols]


def _key(table: str, col: str) -> list[Test]:
    return [Test("unique", table, col), Test("not_null", table, col)]


def _fk(table: str, col: str, to: str, field: str | None = None) -> list[Test]:
    return [Test("not_null", table, col), Test("relationships", table, col, {"to": to, "field": field or col})]


def _min(table: str, col: str, v, inclusive: bool = True) -> list[Test]:
    return [Test("not_null", table, col), Test("accepted_range", table, col, {"min_value": v, "inclusive": inclusive})]


def _known(table: str, dates: list[str], members: list[str]) -> list[Test]:
    """Not the unknown member: an error for dates, a warning for the rest."""
    return [Test("not_unknown", table, c) for c in dates] + [Test("not_unknown", table, c, severity=WARN) for c in members]


def staging_tests() -> list[Test]:
    """The 97 declared tests of the 12 staged frames, as data."""
    t: list[Test] = []
    t += _key("stg_sucursal", "id_sucursal") + _nn("stg_sucursal", "nombre_sucursal")
    t += [Test("expression_is_true", "stg_producto", None, {"expression": "precio_lista >= costo_base"}, WARN,
               "expression_is_true_stg_producto_precio_ge_costo")]
    t += _key("stg_producto", "id_producto") + _key("stg_producto", "sku")
    t += _fk("stg_producto", "categoria", "stg_categoria") + _fk("stg_producto", "marca", "stg_marca")
    for table, key, name in (("stg_categoria", "id_categoria", "categoria"), ("stg_marca", "id_marca", "marca")):
        t += _key(table, key) + _key(table, name)
    t += _min("stg_producto", "costo_base", 0) + _min("stg_producto", "precio_lista", 0)
    t += _key("stg_cliente", "id_cliente") + _nn("stg_cliente", "nombre_cliente", "fecha_alta")
    t += [Test("accepted_values", "stg_cliente", "tipo_cliente", {"values": CUSTOMER_TYPES})]
    t += _key("stg_venta", "id_venta") + _nn("stg_venta", "fecha_venta")
    t += _fk("stg_venta", "id_cliente", "stg_cliente") + _fk("stg_venta", "id_sucursal", "stg_sucursal")
    t += [Test("accepted_values", "stg_venta", "canal", {"values": FX.CHANNELS}),
          Test("accepted_values", "stg_venta", "metodo_pago", {"values": PAYMENT_METHODS}),
          Test("accepted_values", "stg_venta", "estado_venta", {"values": SALE_STATUSES})]
    t += _key("stg_venta_detalle", "id_detalle")
    t += _fk("stg_venta_detalle", "id_venta", "stg_venta") + _fk("stg_venta_detalle", "id_producto", "stg_producto")
    t += _min("stg_venta_detalle", "cantidad", 1) + _min("stg_venta_detalle", "precio_unitario", 0)
    t += _nn("stg_venta_detalle", "descuento_pct") + [Test("valid_percentage", "stg_venta_detalle", "descuento_pct")]
    t += _min("stg_venta_detalle", "monto_neto", 0)
    t += [Test("unique_combination", "stg_inventario", None, {"columns": ["fecha_corte", "id_sucursal", "id_producto"]}),
          Test("expression_is_true", "stg_inventario", None, {"expression": "stock_minimo <= stock_maximo"}, ERROR,
               "expression_is_true_stg_inventario_min_le_max"),
          Test("expression_is_true", "stg_inventario", None, {"expression": "stock_disponible <= stock_maximo"}, WARN,
               "expression_is_true_stg_inventario_stock_le_max")]
    t += _nn("stg_inventario", "fecha_corte", "fecha_vencimiento")
    t += _fk("stg_inventario", "id_sucursal", "stg_sucursal") + _fk("stg_inventario", "id_producto", "stg_producto")
    t += _min("stg_inventario", "stock_disponible", 0) + _min("stg_inventario", "stock_minimo", 0)
    t += [Test("unique_combination", "stg_metas", None, {"columns": ["anio_mes", "id_sucursal"]})]
    t += _nn("stg_metas", "fecha_mes") + _fk("stg_metas", "id_sucursal", "stg_sucursal")
    t += _min("stg_metas", "meta_ventas", 0, inclusive=False) + _min("stg_metas", "meta_unidades", 0, inclusive=False)
    t += [Test("expression_is_true", "stg_promociones", None, {"expression": "fecha_inicio <= fecha_fin"}, ERROR,
               "expression_is_true_stg_promociones_inicio_le_fin")]
    t += _key("stg_promociones", "id_promocion") + _fk("stg_promociones", "categoria", "stg_producto")
    t += _nn("stg_promociones", "porcentaje_descuento") + [Test("valid_percentage", "stg_promociones", "porcentaje_descuento")]
    t += [Test("unique_combination", "stg_proveedores_precios", None, {"columns": ["id_proveedor", "id_producto", "fecha_vigencia"]})]
    t += _nn("stg_proveedores_precios", "id_proveedor") + _fk("stg_proveedores_precios", "id_producto", "stg_producto")
    t += _min("stg_proveedores_precios", "costo_proveedor", 0)
    t += [Test("accepted_range", "stg_proveedores_precios", "plazo_dias", {"min_value": 0})]
    t += _key("stg_devoluciones", "id_devolucion")
    t += _fk("stg_devoluciones", "id_venta", "stg_venta") + _fk("stg_devoluciones", "id_producto", "stg_producto")
    t += _min("stg_devoluciones", "cantidad_devuelta", 1)
    t += [Test("accepted_values", "stg_devoluciones", "motivo", {"values": FX.RETURN_REASONS})]
    return t


def mart_tests() -> list[Test]:
    """Declared tests of the core and reporting models (contracts, FKs, unknown members)."""
    t: list[Test] = []
    for dim, sk in [("dim_sucursal", "sk_sucursal"), ("dim_producto", "sk_producto"), ("dim_cliente", "sk_cliente"),
                    ("dim_proveedor", "sk_proveedor"), ("dim_promocion", "sk_promocion"),
                    ("dim_condicion_venta", "sk_condicion_venta"), ("dim_fecha", "sk_fecha")]:
        t += _key(dim, sk)
    t += _key("fct_ventas", "id_detalle")
    for col, dim in [("sk_fecha", "dim_fecha"), ("sk_cliente", "dim_cliente"), ("sk_producto", "dim_producto"),
                     ("sk_sucursal", "dim_sucursal"), ("sk_condicion_venta", "dim_condicion_venta"),
                     ("sk_promocion", "dim_promocion")]:
        t += _fk("fct_ventas", col, dim)
    t += _known("fct_ventas", ["sk_fecha"], ["sk_cliente", "sk_producto", "sk_sucursal"])
    t += [Test("valid_percentage", "fct_ventas", "descuento_pct")]
    t += _key("fct_devoluciones", "id_devolucion")
    for col, dim in [("sk_fecha", "dim_fecha"), ("sk_producto", "dim_producto"), ("sk_cliente", "dim_cliente"),
                     ("sk_sucursal", "dim_sucursal")]:
        t += _fk("fct_devoluciones", col, dim)
    t += _fk("fct_devoluciones", "sk_fecha_venta", "dim_fecha", "sk_fecha")
    t += _known("fct_devoluciones", ["sk_fecha", "sk_fecha_venta"], ["sk_producto", "sk_cliente", "sk_sucursal"])
    t += _key("fct_inventario_mensual", "sk_inventario")
    for col, dim, fld in [("sk_fecha_corte", "dim_fecha", "sk_fecha"), ("sk_sucursal", "dim_sucursal", "sk_sucursal"),
                          ("sk_producto", "dim_producto", "sk_producto")]:
        t += _fk("fct_inventario_mensual", col, dim, fld)
    t += _fk("fct_inventario_mensual", "sk_fecha_vencimiento", "dim_fecha", "sk_fecha")
    t += _known("fct_inventario_mensual", ["sk_fecha_corte", "sk_fecha_vencimiento"], ["sk_sucursal", "sk_producto"])
    t += [Test("unique_combination", "fct_metas_ventas", None, {"columns": ["anio_mes", "sk_sucursal"]})]
    t += _fk("fct_metas_ventas", "sk_sucursal", "dim_sucursal") + _fk("fct_metas_ventas", "sk_fecha_mes", "dim_fecha", "sk_fecha")
    t += _known("fct_metas_ventas", ["sk_fecha_mes"], ["sk_sucursal"])
    t += [Test("unique_combination", "fct_costos_proveedor", None, {"columns": ["sk_proveedor", "sk_producto", "sk_fecha_vigencia"]})]
    t += _fk("fct_costos_proveedor", "sk_fecha_vigencia", "dim_fecha", "sk_fecha")
    t += _known("fct_costos_proveedor", ["sk_fecha_vigencia"], ["sk_producto"])
    t += _fk("fct_costos_proveedor", "sk_proveedor", "dim_proveedor") + _fk("fct_costos_proveedor", "sk_producto", "dim_producto")
    t += [Test("valid_percentage", "dim_promocion", "porcentaje_descuento")]
    t += [Test("accepted_values", "mart_alertas_inventario", "estado_stock", {"values": STOCK_STATUSES})]
    t += [Test("unique_combination", "mart_cumplimiento_metas", None, {"columns": ["anio_mes", "id_sucursal"]})]
    return t


STAGING_TABLES = ["stg_sucursal", "stg_categoria", "stg_marca", "stg_producto", "stg_cliente", "stg_venta", "stg_venta_detalle", "stg_inventario",
                  "stg_metas", "stg_promociones", "stg_proveedores_precios", "stg_devoluciones"]
MART_TABLES = ["dim_sucursal", "dim_producto", "dim_cliente", "dim_proveedor", "dim_promocion", "dim_condicion_venta",
               "dim_fecha", "fct_ventas", "fct_devoluciones", "fct_inventario_mensual", "fct_metas_ventas",
               "fct_costos_proveedor", "mart_alertas_inventario", "mart_cumplimiento_metas"]


def tables_of(w: Warehouse, names: list[str]) -> dict[str, DataFrame]:
    return {n: getattr(w, n) for n in names}


# ------------------------------------------------------------- singular checks
def i10_return_above_sold(w: Warehouse) -> DataFrame:
    sold = w.stg_venta_detalle.groupBy("id_venta", "id_producto").agg(F.sum("cantidad").cast("bigint").alias("cantidad_vendida"))
    d = w.stg_devoluciones.join(sold, ["id_venta", "id_producto"], "left")
    return d.filter(F.col("cantidad_vendida").isNull() | (F.col("cantidad_devuelta") > F.col("cantidad_vendida"))).select(
        "id_devolucion", "id_venta", "id_producto", "cantidad_devuelta", "cantidad_vendida"
    )


def i11_return_before_sale(w: Warehouse) -> DataFrame:
    v = w.stg_venta.select("id_venta", "fecha_venta")
    return w.stg_devoluciones.join(v, "id_venta").filter(F.col("fecha_devolucion") < F.col("fecha_venta")).select(
        "id_devolucion", "id_venta", "fecha_venta", "fecha_devolucion"
    )


def i12_promotion_overlaps(w: Warehouse) -> DataFrame:
    o = overlaps(w.stg_promociones, "categoria", "fecha_inicio", "fecha_fin", "id_promocion")
    return o.withColumnRenamed("id_promocion_a", "promocion_a").withColumnRenamed("id_promocion_b", "promocion_b")


def i13_reconciliation(w: Warehouse) -> DataFrame:
    """Raw vs fact: lines + amount and rows + units, one row each with both sides.

    Each side is a one-row aggregate, evaluated once; the comparison is null-safe.
    """
    raw_l = w.fx.linea().agg(F.count(F.lit(1)).alias("a"), F.sum("subtotal").cast("decimal(38,2)").alias("b"))
    fct_l = w.fct_ventas.agg(F.count(F.lit(1)).alias("a"), F.sum("monto_neto").cast("decimal(38,2)").alias("b"))
    raw_i = w.fx.inventario().agg(F.count(F.lit(1)).alias("a"), F.sum("stock_disponible").cast("decimal(38,2)").alias("b"))
    fct_i = w.fct_inventario_mensual.agg(F.count(F.lit(1)).alias("a"), F.sum("stock_disponible").cast("decimal(38,2)").alias("b"))

    def row(name: str, r: DataFrame, f: DataFrame) -> DataFrame:
        return r.crossJoin(f.select(F.col("a").alias("filas_fct"), F.col("b").alias("total_fct"))).select(
            F.lit(name).alias("reconciliacion"), F.col("a").alias("filas_raw"), "filas_fct", F.col("b").alias("total_raw"), "total_fct")

    out = row("ventas", raw_l, fct_l).unionByName(row("inventario", raw_i, fct_i))
    return out.withColumn(
        "cuadra", F.col("filas_raw").eqNullSafe(F.col("filas_fct")) & F.col("total_raw").eqNullSafe(F.col("total_fct"))
    )


def i14_subtotal_consistency(w: Warehouse) -> DataFrame:
    d = w.stg_venta_detalle
    expected = F.round(F.col("cantidad") * F.col("precio_unitario") * (F.lit(1) - F.col("descuento_pct")), 2)
    return d.filter(F.abs(F.col("monto_neto") - expected) > F.lit(0.01)).select(
        "id_detalle", "cantidad", "precio_unitario", "descuento_pct", "monto_neto", expected.alias("monto_esperado")
    )


def i15_expiry_before_cutoff(w: Warehouse) -> DataFrame:
    return w.stg_inventario.filter(F.col("fecha_vencimiento") < F.col("fecha_corte")).select(
        "fecha_corte", "id_sucursal", "id_producto", "lote", "fecha_vencimiento"
    )


def i16_sale_before_signup(w: Warehouse) -> DataFrame:
    c = w.stg_cliente.select("id_cliente", "fecha_alta")
    return w.stg_venta.join(c, "id_cliente").filter(F.col("fecha_venta") < F.col("fecha_alta")).select(
        "id_venta", "fecha_venta", "id_cliente", "fecha_alta"
    )


# ---------------------------------------------------------- post-build checks
def i17_raw_not_empty(w: Warehouse) -> DataFrame:
    """Row count of every raw source (a violation is a zero)."""
    fx = w.fx
    srcs = [("sucursal", fx.sucursal()), ("producto", fx.producto()), ("cliente", fx.cliente()), ("venta", fx.venta()),
            ("venta_detalle", fx.linea()), ("inventario", fx.inventario()), ("metas", fx.meta()),
            ("promociones", fx.promocion()), ("proveedores_precios", fx.proveedor_precio()), ("devoluciones", fx.devolucion()),
            ("categoria", w.stg_categoria), ("marca", w.stg_marca)]
    parts = [df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas")) for name, df in srcs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def i18_counts_raw_vs_marts(w: Warehouse) -> DataFrame:
    fx = w.fx
    pairs = [("fct_ventas", fx.linea(), w.fct_ventas, 0), ("fct_inventario_mensual", fx.inventario(), w.fct_inventario_mensual, 0),
             ("fct_devoluciones", fx.devolucion(), w.fct_devoluciones, 0), ("fct_metas_ventas", fx.meta(), w.fct_metas_ventas, 0),
             ("fct_costos_proveedor", fx.proveedor_precio(), w.fct_costos_proveedor, 0),
             ("dim_cliente", fx.cliente(), w.dim_cliente, 1), ("dim_producto", fx.producto(), w.dim_producto, 1),
             ("dim_sucursal", fx.sucursal(), w.dim_sucursal, 1), ("dim_promocion", fx.promocion(), w.dim_promocion, 1)]
    parts = [
        raw.agg((F.count(F.lit(1)) + F.lit(plus)).alias("filas_raw")).select(
            F.lit(name).alias("entidad"), "filas_raw", F.lit(mart.agg(F.count(F.lit(1))).scalar()).alias("filas_marts")
        )
        for name, raw, mart, plus in pairs
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def i19_calendar_gaps(w: Warehouse) -> DataFrame:
    dates = (
        w.fx.venta().select("fecha")
        .union(w.fx.inventario().select(F.col("fecha_corte").alias("fecha")))
        .union(w.fx.inventario().select(F.col("fecha_vencimiento").alias("fecha")))
        .distinct()
    )
    cal = w.calendar("fecha")
    return dates.join(cal, "fecha", "left_anti").select(F.lit("fecha fuera de dim_fecha").alias("problema"), "fecha")


def _without(rows: DataFrame, key: str, parents: DataFrame, null_safe: bool = True) -> DataFrame:
    """Rows whose key ``parents`` lack; NULL is such a key if ``null_safe``.

    Only distinct keys meet the parents. The missing ones are written: if there
    are none no row is looked at, and a few are broadcast by their size, so the
    rows stay where they are.
    """
    missing = rows.select(key).distinct().join(parents.select(key), key, "left_anti")
    missing = missing if null_safe else missing.where(F.col(key).isNotNull())
    path = scratch_path(rows.sparkSession, "missing-keys")
    missing.write.parquet(path)
    missing = rows.sparkSession.read.schema(missing.schema).parquet(path).select(F.col(key).alias("__missing"))
    if missing.isEmpty():
        return rows.where(F.lit(False))
    k = F.col(key)
    return rows.join(missing, k.eqNullSafe(F.col("__missing")) if null_safe else k == F.col("__missing"), "left_semi")


def i20_raw_orphans(w: Warehouse) -> DataFrame:
    """Six raw referential checks as (check, key) rows."""
    fx = w.fx
    v, c, s, d, p = fx.venta(), fx.cliente(), fx.sucursal(), fx.linea(), fx.producto()
    checks = [
        ("venta_sin_cliente", v.join(c.select("id_cliente"), "id_cliente", "left_anti").select(F.col("id_venta").cast("string").alias("llave"))),
        ("venta_sin_sucursal", v.join(s.select("id_sucursal"), "id_sucursal", "left_anti").select(F.col("id_venta").cast("string").alias("llave"))),
        ("detalle_sin_venta_o_producto",
         _without(d.select("id_detalle", "id_venta"), "id_venta", v).select("id_detalle")
         .union(_without(d.select("id_detalle", "id_producto"), "id_producto", p).select("id_detalle"))
         .distinct().select(F.col("id_detalle").alias("llave"))),
        ("inventario_sin_producto_o_sucursal",
         _without(fx.inventario().select("fecha_corte", "id_sucursal", "id_producto"), "id_producto", p)
         .union(_without(fx.inventario().select("fecha_corte", "id_sucursal", "id_producto"), "id_sucursal", s))
         .distinct().select(F.concat_ws("/", "fecha_corte", "id_sucursal", "id_producto").alias("llave"))),
        ("devolucion_sin_linea_vendida",
         fx.devolucion().join(d.select("id_venta", "id_producto"), ["id_venta", "id_producto"], "left_anti")
         .select(F.col("id_devolucion").alias("llave"))),
        ("proveedor_producto_inexistente",
         _without(fx.proveedor_precio().select("id_proveedor", "id_producto"), "id_producto", p)
         .select(F.concat_ws("/", "id_proveedor", "id_producto").alias("llave"))),
    ]
    parts = [df.select(F.lit(n).alias("check_name"), "llave") for n, df in checks]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def i21_fact_orphans(w: Warehouse) -> DataFrame:
    """Lines with a key that its dimension lacks; only distinct keys meet the dimensions."""
    dims = {"sk_fecha": w.calendar("sk_fecha"), "sk_cliente": w.dim_cliente, "sk_producto": w.dim_producto, "sk_sucursal": w.dim_sucursal}
    out = None
    for key, dim in dims.items():
        found = _without(w.fct_ventas.select("id_detalle", key), key, dim, null_safe=False).select("id_detalle")
        out = found if out is None else out.unionAll(found)
    return out.distinct()


def i22_facts_on_unknown(w: Warehouse) -> DataFrame:
    u = sk_unknown()
    a = w.fct_ventas.filter((F.col("sk_cliente") == u) | (F.col("sk_producto") == u) | (F.col("sk_sucursal") == u) | (F.col("sk_fecha") == -1))
    b = w.fct_inventario_mensual.filter((F.col("sk_producto") == u) | (F.col("sk_sucursal") == u) | (F.col("sk_fecha_corte") == -1))
    ra = a.agg(F.lit("fct_ventas").alias("hecho"), F.count(F.lit(1)).alias("filas")).filter("filas > 0")
    rb = b.agg(F.lit("fct_inventario_mensual").alias("hecho"), F.count(F.lit(1)).alias("filas")).filter("filas > 0")
    return ra.unionByName(rb)


def i23_declared_fks(w: Warehouse) -> DataFrame:
    """The 20 declared star-schema relationships verified on data: one result row each."""
    fks = [t for t in mart_tests() if t.kind == "relationships"]
    return Q.run_tests(w.spark, tables_of(w, MART_TABLES), fks)


def i24_null_keys(w: Warehouse) -> DataFrame:
    fx = w.fx
    cols = [("cliente.id_cliente", fx.cliente(), "id_cliente"), ("producto.id_producto", fx.producto(), "id_producto"),
            ("venta.id_venta", fx.venta(), "id_venta"), ("venta_detalle.id_detalle", fx.linea(), "id_detalle"),
            ("devoluciones.id_devolucion", fx.devolucion(), "id_devolucion")]
    parts = [df.agg(F.lit(n).alias("columna"), F.count_if(F.col(c).isNull()).alias("nulos")).filter("nulos > 0") for n, df, c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def i25_duplicate_keys(w: Warehouse) -> DataFrame:
    fx = w.fx
    specs = [("cliente", fx.cliente(), ["id_cliente"]), ("producto", fx.producto(), ["id_producto"]),
             ("venta", fx.venta(), ["id_venta"]), ("inventario", fx.inventario(), ["fecha_corte", "id_sucursal", "id_producto"])]
    parts = [
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("veces")).filter("veces > 1")
        .select(F.lit(n).alias("tabla"), F.concat_ws("/", *keys).alias("llave"), "veces")
        for n, df, keys in specs
    ]
    lines = fx.linea().groupBy(packed("id_detalle").alias("k")).agg(F.count(F.lit(1)).alias("veces")).filter("veces > 1")
    parts.append(lines.select(F.lit("venta_detalle").alias("tabla"), F.coalesce(unpacked("k"), F.lit("")).alias("llave"), "veces"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def i26_null_measures(w: Warehouse) -> DataFrame:
    fx = w.fx
    a = fx.linea().filter(F.col("cantidad").isNull() | F.col("precio_unitario").isNull() | F.col("subtotal").isNull()).select(
        F.lit("venta_detalle").alias("tabla"), F.col("id_detalle").alias("llave"))
    b = fx.proveedor_precio().filter(F.col("costo_proveedor").isNull()).select(
        F.lit("proveedores_precios").alias("tabla"), F.concat_ws("/", "id_proveedor", "id_producto").alias("llave"))
    c = fx.inventario().filter(F.col("stock_disponible").isNull()).select(
        F.lit("inventario_bodega").alias("tabla"), F.concat_ws("/", "fecha_corte", "id_sucursal", "id_producto").alias("llave"))
    return a.unionByName(b).unionByName(c)


def i27_dim_natural_keys_unique(w: Warehouse) -> DataFrame:
    specs = [("dim_cliente", w.dim_cliente, "id_cliente"), ("dim_producto", w.dim_producto, "id_producto"),
             ("dim_sucursal", w.dim_sucursal, "id_sucursal"), ("dim_fecha", w.dim_fecha.filter(F.col("fecha").isNotNull()), "fecha")]
    parts = [df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit(n).alias("dimension"), F.col(c).cast("string").alias("llave"))
             for n, df, c in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def i28_one_unknown_member(w: Warehouse) -> DataFrame:
    specs = [("dim_cliente", w.dim_cliente, F.col("id_cliente") == -1), ("dim_producto", w.dim_producto, F.col("id_producto") == -1),
             ("dim_sucursal", w.dim_sucursal, F.col("id_sucursal") == -1), ("dim_promocion", w.dim_promocion, F.col("id_promocion") == -1),
             ("dim_fecha", w.dim_fecha, F.col("sk_fecha") == -1)]
    parts = [df.agg(F.lit(n).alias("dimension"), F.count_if(cond).alias("miembros")) for n, df, cond in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("miembros <> 1")


def _amounts_differ():
    expected = F.round(F.col("cantidad") * F.col("precio_unitario") * (F.lit(1) - F.col("descuento_pct")), 2)
    return F.coalesce((F.abs(F.col("monto_neto") - expected) > 0.01) | ((F.col("monto_bruto") - F.col("monto_descuento")) != F.col("monto_neto")), F.lit(False))


def _values_impossible():
    return F.coalesce((F.col("cantidad") <= 0) | (F.col("precio_unitario") < 0) | ~F.col("descuento_pct").between(0, 1), F.lit(False))


def i29_sale_values(w: Warehouse) -> DataFrame:
    return w.fct_ventas.filter(_amounts_differ() | _values_impossible()).select("id_detalle", "cantidad", "precio_unitario", "descuento_pct", "monto_neto")


def i30_stock_rules(w: Warehouse) -> DataFrame:
    i = w.fct_inventario_mensual
    bad = (F.col("stock_disponible") < 0) | (F.col("stock_minimo") > F.col("stock_maximo")) | (F.col("dias_para_vencer") < 0)
    return i.filter(F.coalesce(bad, F.lit(False))).select("sk_inventario", "stock_disponible", "dias_para_vencer")


def i31_goals_positive(w: Warehouse) -> DataFrame:
    m = w.fct_metas_ventas
    return m.filter((F.col("meta_ventas") <= 0) | (F.col("meta_unidades") <= 0)).select("anio_mes", "sk_sucursal", "meta_ventas")


def i32_over_stock(w: Warehouse) -> DataFrame:
    return w.fct_inventario_mensual.filter("es_sobre_maximo").select("sk_inventario", "stock_disponible", "stock_maximo")


def i10_mart_return_above_sold(w: Warehouse) -> DataFrame:
    """Mart form of I10: returned more than sold of that product in that sale."""
    product = packed("sk_producto").alias("__producto")
    sold = w.fct_ventas.groupBy("id_venta", product).agg(F.sum("cantidad").cast("bigint").alias("cantidad_vendida"))
    d = w.fct_devoluciones.select("*", product).join(sold, ["id_venta", "__producto"], "inner")
    return d.filter(F.col("cantidad_devuelta") > F.col("cantidad_vendida")).select("id_devolucion", "cantidad_devuelta", "cantidad_vendida")


def i11_mart_return_before_sale(w: Warehouse) -> DataFrame:
    return w.fct_devoluciones.filter(F.col("dias_desde_venta") < 0).select("id_devolucion", "dias_desde_venta")


def i16_mart_sale_before_signup(w: Warehouse) -> DataFrame:
    cal = w.calendar("sk_fecha", "fecha")
    per_sale = w.fct_ventas.select("id_venta", "sk_fecha", "sk_cliente").distinct()
    j = per_sale.join(cal, "sk_fecha").join(w.dim_cliente.select("sk_cliente", "fecha_alta"), "sk_cliente")
    return j.filter(F.col("fecha") < F.col("fecha_alta")).select("id_venta", F.col("fecha").alias("fecha_venta"), "fecha_alta").distinct()


def _load_raw(w: Warehouse) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``i33_source_vs_raw`` and the loaded tables that it counts, by their roles."""
    fx, root, tables = w.fx, scratch_path(w.spark, "i33_raw"), {}
    srcs = {"sucursal": fx.sucursal(), "producto": fx.producto(), "cliente": fx.cliente(), "venta": fx.venta(),
            "venta_detalle": fx.linea(), "inventario": fx.inventario(), "devoluciones": fx.devolucion()}
    out = None
    for name, src in srcs.items():
        L.full_load(src, f"{root}/{name}")
        tables[ROLES.get(name, name)] = L.read_current(w.spark, f"{root}/{name}")
        loaded = tables[ROLES.get(name, name)].agg(F.count(F.lit(1))).scalar()
        one = src.agg(F.count(F.lit(1)).alias("filas_origen")).select(F.lit(name).alias("tabla"), "filas_origen", loaded.alias("filas_raw"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("failing_rows", F.abs(F.col("filas_origen") - F.col("filas_raw"))), tables


def i33_source_vs_raw(w: Warehouse) -> DataFrame:
    """Source vs loaded count per table; failing count = absolute difference.

    Each source is loaded into a table of its own, and the table read back.
    """
    return _load_raw(w)[0]


def _over(w: Warehouse, tables: dict[str, DataFrame]) -> Warehouse:
    """``w`` with its own star over raw ``tables``, which are read instead of being derived for each check."""
    raw = w.copy(calendar_range=w.calendar_range, **tables_of(w, [*MART_TABLES, "stg_categoria", "stg_marca"]))
    raw.fx = copy.copy(w.fx)
    raw.fx.__dict__.update({name: lambda frame=frame: frame for name, frame in tables.items()})
    return raw


def singular_checks(w: Warehouse) -> list[Check]:
    return [
        Check("assert_devolucion_no_supera_vendido", "singular", ERROR, i10_return_above_sold(w)),
        Check("assert_devolucion_posterior_a_venta", "singular", ERROR, i11_return_before_sale(w)),
        Check("assert_promociones_sin_traslape", "singular", WARN, i12_promotion_overlaps(w)),
        Check("assert_reconciliacion_raw_vs_fct", "singular", ERROR, i13_reconciliation(w).filter(~F.col("cuadra"))),
        Check("assert_subtotal_consistente", "singular", ERROR, i14_subtotal_consistency(w)),
        Check("assert_vencimiento_posterior_al_corte", "singular", ERROR, i15_expiry_before_cutoff(w)),
        Check("assert_venta_posterior_alta_cliente", "singular", WARN, i16_sale_before_signup(w)),
    ]


ROLES = {"venta_detalle": "linea", "devoluciones": "devolucion"}  # of tables that are named unlike their source
RECONCILED = ["sucursal", "producto", "cliente", "venta", "venta_detalle", "inventario", "devoluciones"]
ORPHANS = ["venta_sin_cliente", "venta_sin_sucursal", "detalle_sin_venta_o_producto", "inventario_sin_producto_o_sucursal", "devolucion_sin_linea_vendida",
           "proveedor_producto_inexistente"]


def post_build_checks(w: Warehouse) -> list[Check]:
    """The 34 checks after a build: each result has a name of its own."""
    loaded, tables = _load_raw(w)
    w = _over(w, tables)
    orphans, sums = i20_raw_orphans(w), i13_reconciliation(w).filter(~F.col("cuadra"))
    # a filter on the name leaves only its branch of the union in the plan
    return [
        *[Check(f"reconciliacion_origen_raw_{t}", "conteo", ERROR, loaded.filter((F.col("tabla") == t) & (F.col("failing_rows") > 0))) for t in RECONCILED],
        Check("raw_tablas_con_datos", "conteo", ERROR, i17_raw_not_empty(w).filter("filas = 0")),
        Check("reconciliacion_conteos_raw_vs_marts", "conteo", ERROR, i18_counts_raw_vs_marts(w).filter("filas_raw <> filas_marts")),
        Check("reconciliacion_montos_ventas", "conteo", ERROR, sums.filter("reconciliacion = 'ventas'")),
        Check("reconciliacion_stock_inventario", "conteo", ERROR, sums.filter("reconciliacion = 'inventario'")),
        Check("dim_fecha_cubre_hechos", "conteo", ERROR, i19_calendar_gaps(w)),
        *[Check(f"raw_{n}", "integridad", ERROR, orphans.filter(F.col("check_name") == n)) for n in ORPHANS],
        Check("marts_fct_ventas_huerfanos", "integridad", ERROR, i21_fact_orphans(w)),
        Check("marts_hechos_en_miembro_desconocido", "integridad", WARN, i22_facts_on_unknown(w)),
        Check("marts_relaciones_declaradas", "integridad", ERROR, i23_declared_fks(w).filter(~F.col("passed"))),
        Check("raw_llaves_nulas", "nulos_unicidad", ERROR, i24_null_keys(w)),
        Check("raw_llaves_duplicadas", "nulos_unicidad", ERROR, i25_duplicate_keys(w)),
        Check("raw_medidas_nulas", "nulos_unicidad", ERROR, i26_null_measures(w)),
        Check("marts_llaves_naturales_unicas", "nulos_unicidad", ERROR, i27_dim_natural_keys_unique(w)),
        Check("marts_un_solo_miembro_desconocido", "nulos_unicidad", ERROR, i28_one_unknown_member(w)),
        Check("ventas_montos_consistentes", "negocio", ERROR, w.fct_ventas.filter(_amounts_differ()).select("id_detalle")),
        Check("ventas_valores_validos", "negocio", ERROR, w.fct_ventas.filter(_values_impossible()).select("id_detalle")),
        Check("devoluciones_no_superan_venta", "negocio", ERROR, i10_mart_return_above_sold(w)),
        Check("devoluciones_posteriores_a_venta", "negocio", ERROR, i11_mart_return_before_sale(w)),
        Check("inventario_sin_negativos_ni_vencidos", "negocio", ERROR, i30_stock_rules(w)),
        Check("metas_positivas", "negocio", ERROR, i31_goals_positive(w)),
        Check("inventario_sobre_stock", "negocio", WARN, i32_over_stock(w)),
        Check("ventas_antes_del_alta_cliente", "negocio", WARN, i16_mart_sale_before_signup(w)),
    ]


def i34_staging_results(w: Warehouse) -> DataFrame:
    return Q.run_tests(w.spark, tables_of(w, STAGING_TABLES), staging_tests())


def i34_mart_results(w: Warehouse) -> DataFrame:
    return Q.run_tests(w.spark, tables_of(w, MART_TABLES), mart_tests())


def i34_singular_results(w: Warehouse) -> DataFrame:
    """Each check reads the few columns it needs: no fact is written for the sums of two of its columns."""
    return Q.run_checks(w.spark, singular_checks(w.copy()))


def i34_post_build_results(w: Warehouse) -> DataFrame:
    return Q.run_checks(w.spark, post_build_checks(w))


def i36_stage_gate(w: Warehouse) -> DataFrame:
    """Whether marts may be published: no failed error check among staging + singular tests."""
    return Q.gate(i34_staging_results(w).unionByName(i34_singular_results(w)))
