"""Warehouse queries J01-J13 and dashboard datasets J21-J28.

Each takes a ``Warehouse`` and returns a DataFrame. Pattern used throughout:
aggregate the fact by its foreign keys first (map-side partial aggregation
makes the shuffle one row per key per task), then join the - now small -
aggregates with the dimensions. ``count(DISTINCT id_venta)`` becomes a
two-stage aggregate (by sale, then by group) instead of Spark's Expand.
Windows without PARTITION BY (lag, rank, share of total) only run on those
aggregated frames. Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject)
with a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.functions import exprs as X
from dwspark.plans.warehouse import Warehouse


def _valid_sales(w: Warehouse) -> DataFrame:
    return w.fct_ventas.filter(F.col("es_venta_valida"))


def _calendar(w: Warehouse, *cols: str) -> DataFrame:
    return w.calendar("sk_fecha", *cols)


def _per_sale(f: DataFrame, keys: list[str], **sums) -> DataFrame:
    """Stage 1 of a distinct-sale count: one row per (keys, id_venta)."""
    return f.groupBy(*keys, "id_venta").agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def j01_monthly_sales(w: Warehouse) -> DataFrame:
    """Monthly net sales, margin %, ticket, month-over-month %."""
    f = _valid_sales(w).join(_calendar(w, "anio_mes"), "sk_fecha")
    per_sale = _per_sale(f, ["anio_mes"], n="monto_neto", m="margen_bruto")
    m = per_sale.groupBy("anio_mes").agg(
        X.sum_dec("n").alias("venta_neta"), X.sum_dec("m").alias("margen_bruto"), F.count(F.lit(1)).alias("num_ventas")
    )
    prev = F.lag("venta_neta").over(Window.orderBy("anio_mes"))  # ~one row per month
    return m.select(
        "anio_mes",
        "venta_neta",
        "margen_bruto",
        X.pct("margen_bruto", "venta_neta").alias("margen_pct"),
        "num_ventas",
        X.safe_div("venta_neta", "num_ventas", 2).alias("ticket_promedio"),
        X.growth_pct(F.col("venta_neta"), prev).alias("variacion_pct"),
    )


def _by_product(w: Warehouse, f: DataFrame | None = None) -> DataFrame:
    f = _valid_sales(w) if f is None else f
    return f.groupBy("sk_producto").agg(
        F.sum("monto_neto").alias("n"), F.sum("margen_bruto").alias("m"), F.sum("cantidad").alias("u")
    )


def j02_category_brand(w: Warehouse, k: int = 15) -> DataFrame:
    """Category x brand: sales, margin %, share of total; top 15."""
    p = w.dim_producto.select("sk_producto", "categoria", "marca")
    g = _by_product(w).join(p, "sk_producto").groupBy("categoria", "marca").agg(
        X.sum_dec("n").alias("venta_neta"), X.sum_dec("m").alias("margen_bruto")
    )
    total = F.sum("venta_neta").over(Window.partitionBy())  # aggregated frame: categories x brands
    out = g.select(
        "categoria",
        "marca",
        "venta_neta",
        "margen_bruto",
        X.pct("margen_bruto", "venta_neta").alias("margen_pct"),
        X.pct(F.col("venta_neta"), total).alias("participacion_pct"),
    )
    return out.orderBy(F.col("venta_neta").desc(), "categoria", "marca").limit(k)


def j03_top_products(w: Warehouse, k: int = 10) -> DataFrame:
    """Top 10 products by revenue with rank and margin %."""
    p = w.dim_producto.select("sk_producto", "sku", "nombre_producto", "categoria")
    g = _by_product(w).join(p, "sk_producto").groupBy("sku", "nombre_producto", "categoria").agg(
        X.sum_int("u").alias("unidades"), X.sum_dec("n").alias("venta_neta"), X.sum_dec("m").alias("m")
    )
    top = g.orderBy(F.col("venta_neta").desc(), "sku").limit(k)
    # rank over the whole grouping equals rank within the top k: nothing outside ranks above it
    ranked = top.withColumn("ranking", F.rank().over(Window.orderBy(F.col("venta_neta").desc())).cast("bigint"))
    return ranked.select(
        "ranking", "sku", "nombre_producto", "categoria", "unidades", "venta_neta",
        X.pct("m", "venta_neta").alias("margen_pct"),
    )


def j04_branch_goals(w: Warehouse) -> DataFrame:
    """Branch goal attainment over the period, ranked."""
    g = w.mart_cumplimiento_metas.groupBy("nombre_sucursal").agg(
        X.sum_dec("meta_ventas").alias("meta_total"),
        X.sum_dec("venta_neta").alias("venta_total"),
        X.sum_dec("monto_devuelto").alias("devoluciones"),
    )
    ratio = F.col("venta_total").cast("double") / F.nullif(F.col("meta_total").cast("double"), F.lit(0.0))
    return g.select(
        "nombre_sucursal",
        "meta_total",
        "venta_total",
        X.pct("venta_total", "meta_total").alias("cumplimiento_pct"),
        "devoluciones",
        F.rank().over(Window.orderBy(ratio.desc_nulls_first())).cast("bigint").alias("ranking"),
    )


def j05_channel_payment(w: Warehouse) -> DataFrame:
    """Channel x payment with cancellation rate."""
    # one row a condition before any join: its few dozen keys never meet the lines
    per_sale = w.fct_ventas.groupBy("sk_condicion_venta", "id_venta").agg(F.sum(F.when(F.col("es_venta_valida"), F.col("monto_neto"))).alias("n"))
    per_condition = per_sale.groupBy("sk_condicion_venta").agg(F.count(F.lit(1)).alias("ventas"), F.sum("n").alias("n"))
    g = per_condition.join(w.dim_condicion_venta, "sk_condicion_venta").groupBy("canal", "metodo_pago").agg(
        F.sum("ventas").cast("bigint").alias("ventas"),
        F.coalesce(F.sum(F.when(F.col("estado_venta") == "ANULADA", F.col("ventas"))), F.lit(0)).cast("bigint").alias("anuladas"),
        X.sum_dec("n").alias("venta_neta"),
    )
    return g.select(
        "canal", "metodo_pago", "ventas", "anuladas",
        X.pct("anuladas", "ventas").alias("tasa_anulacion_pct"), "venta_neta",
    )


def j06_promotion_effect(w: Warehouse) -> DataFrame:
    """Lines with / without a promotion by category."""
    g = _valid_sales(w).groupBy("sk_producto", "sk_promocion").agg(
        F.count(F.lit(1)).alias("c"), F.sum("cantidad").alias("u"), F.sum("descuento_pct").alias("d"), F.sum("monto_neto").alias("n")
    )
    pr = w.promotion_side(w.dim_promocion.select("sk_promocion", "id_promocion"))
    p = w.dim_producto.select("sk_producto", "categoria")
    tipo = F.when(F.col("id_promocion") == -1, F.lit("Sin promoción")).otherwise(F.lit("Con promoción"))
    j = g.join(pr, "sk_promocion").join(p, "sk_producto").withColumn("tipo", tipo)
    a = j.groupBy("categoria", "tipo").agg(
        F.sum("c").alias("lineas"), F.sum("u").alias("u"), F.sum("d").alias("d"), X.sum_dec("n").alias("venta_neta")
    )
    return a.select(
        "categoria", "tipo", "lineas",
        X.safe_div("u", "lineas", 2).alias("unidades_promedio_linea"),
        X.safe_div("d", "lineas", 2, factor=100.0).alias("descuento_promedio_pct"),
        "venta_neta",
    )


def j07_returns_rollup(w: Warehouse) -> DataFrame:
    """Returns by category and reason with ROLLUP subtotals."""
    parts = {"c": F.count(F.lit(1)), "u": F.sum("cantidad_devuelta"), "m": F.sum("monto_devuelto"), "d": F.sum("dias_desde_venta"), "n": F.count("dias_desde_venta")}
    per_product = w.fct_devoluciones.groupBy("sk_producto", "motivo").agg(*[v.alias(k) for k, v in parts.items()])
    again = [F.sum(k).alias(k) for k in parts]
    # the lowest level first: the rollup triples its rows, not the returns
    lowest = per_product.join(w.dim_producto.select("sk_producto", "categoria"), "sk_producto").groupBy("categoria", "motivo").agg(*again)
    g = lowest.rollup("categoria", "motivo").agg(
        F.sum("c").cast("bigint").alias("devoluciones"),
        X.sum_int("u").alias("unidades"),
        X.sum_dec("m").alias("monto_devuelto"),
        F.sum("d").alias("__dias"),
        F.sum("n").alias("__n"),
        F.grouping_id().cast("int").alias("nivel"),
    )
    return g.select(
        "categoria", "motivo", "devoluciones", "unidades", "monto_devuelto",
        X.safe_div("__dias", "__n", 1).alias("dias_promedio_desde_venta"), "nivel",
    )


def j08_inventory_status(w: Warehouse) -> DataFrame:
    """Inventory status by branch at the last cut-off."""
    a = w.mart_alertas_inventario
    return a.groupBy("nombre_sucursal").agg(
        F.count_if(F.col("estado_stock") == "SIN STOCK").alias("sin_stock"),
        F.count_if(F.col("estado_stock") == "BAJO MÍNIMO").alias("bajo_minimo"),
        F.count_if(F.col("estado_stock") == "SOBRE STOCK").alias("sobre_stock"),
        F.count_if("vence_en_60_dias").alias("vencen_en_60_dias"),
        X.sum_dec("valor_inventario").alias("valor_inventario"),
    )


def j09_reorder(w: Warehouse, k: int = 15) -> DataFrame:
    """Low or zero stock with recent sales, top 15 by average sales."""
    a = w.mart_alertas_inventario.filter(
        F.col("estado_stock").isin("SIN STOCK", "BAJO MÍNIMO") & (F.col("unidades_promedio_mes") > 0)
    )
    return a.select(
        "nombre_sucursal", "sku", "nombre_producto", "stock_disponible", "stock_minimo", "unidades_promedio_mes", "estado_stock"
    ).orderBy(F.col("unidades_promedio_mes").desc(), "nombre_sucursal", "sku").limit(k)


def j10_inventory_value(w: Warehouse) -> DataFrame:
    """Inventory value by month x category; summed within a month only."""
    i = w.fct_inventario_mensual.groupBy("sk_fecha_corte", "sk_producto").agg(
        F.sum("stock_disponible").alias("s"), F.sum("valor_inventario").alias("v")
    )
    cal = _calendar(w, "anio_mes").withColumnRenamed("sk_fecha", "sk_fecha_corte")
    p = w.dim_producto.select("sk_producto", "categoria")
    return i.join(cal, "sk_fecha_corte").join(p, "sk_producto").groupBy("anio_mes", "categoria").agg(
        X.sum_int("s").alias("unidades_en_stock"), X.sum_dec("v").alias("valor_inventario")
    )


def j11_customer_type(w: Warehouse) -> DataFrame:
    """Customers, sales and ticket by customer type."""
    per_customer = _per_sale(_valid_sales(w), ["sk_cliente"], n="monto_neto").groupBy("sk_cliente").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")
    )
    c = w.dim_cliente.select("sk_cliente", "tipo_cliente")
    g = per_customer.join(c, "sk_cliente").groupBy("tipo_cliente").agg(
        F.count(F.lit(1)).alias("clientes"), F.sum("v").alias("ventas"), X.sum_dec("n").alias("venta_neta")
    )
    return g.select("tipo_cliente", "clientes", "ventas", "venta_neta", X.safe_div("venta_neta", "ventas", 2).alias("ticket_promedio"))


def j12_cheapest_supplier(w: Warehouse, k: int = 15) -> DataFrame:
    """Cheapest supplier per product and saving vs base cost, top 15."""
    c = w.fct_costos_proveedor.filter(F.col("es_proveedor_mas_barato"))
    p = w.dim_producto.select("sk_producto", "sku", "nombre_producto")
    pv = w.dim_proveedor.select("sk_proveedor", F.col("nombre_proveedor").alias("proveedor_mas_barato"))
    j = c.join(p, "sk_producto").join(pv, "sk_proveedor")
    return j.select(
        "sku", "nombre_producto", "proveedor_mas_barato", "costo_proveedor", "costo_base_producto",
        "diferencia_vs_costo_base", "plazo_dias",
    ).orderBy(F.col("diferencia_vs_costo_base").asc_nulls_last(), "sku", "proveedor_mas_barato").limit(k)


def j13_weekday(w: Warehouse) -> DataFrame:
    """Sales by ISO weekday."""
    f = _valid_sales(w).join(_calendar(w, "dia_semana_iso", "nombre_dia"), "sk_fecha")
    per_sale = _per_sale(f, ["dia_semana_iso", "nombre_dia"], n="monto_neto")
    return per_sale.groupBy("dia_semana_iso", "nombre_dia").agg(
        F.count(F.lit(1)).alias("ventas"), X.sum_dec("n").alias("venta_neta")
    )


# ------------------------------------------------------------ dashboard cards
def j21_kpis(w: Warehouse) -> DataFrame:
    """Net sales, margin %, distinct sales, return rate %."""
    per_sale = _per_sale(_valid_sales(w), [], n="monto_neto", m="margen_bruto")
    t = per_sale.agg(X.sum_dec("n").alias("venta_neta"), X.sum_dec("m").alias("__m"), F.count(F.lit(1)).alias("ventas"))
    returned = w.fct_devoluciones.agg(F.sum("monto_devuelto")).scalar()
    return t.select(
        "venta_neta",
        X.pct("__m", "venta_neta").alias("margen_pct"),
        "ventas",
        X.pct(returned, F.col("venta_neta")).alias("tasa_devolucion_pct"),
    )


def j22_monthly(w: Warehouse) -> DataFrame:
    f = _valid_sales(w).groupBy("sk_fecha").agg(F.sum("monto_neto").alias("n"), F.sum("margen_bruto").alias("m"))
    return f.join(_calendar(w, "anio_mes"), "sk_fecha").groupBy("anio_mes").agg(
        X.sum_dec("n").alias("venta_neta"), X.sum_dec("m").alias("margen_bruto")
    )


def j23_by_category(w: Warehouse) -> DataFrame:
    p = w.dim_producto.select("sk_producto", "categoria")
    return _by_product(w).join(p, "sk_producto").groupBy("categoria").agg(X.sum_dec("n").alias("venta_neta"))


def j24_actual_vs_goal(w: Warehouse) -> DataFrame:
    return w.mart_cumplimiento_metas.groupBy("anio_mes").agg(
        X.sum_dec("venta_neta").alias("venta_real"), X.sum_dec("meta_ventas").alias("meta")
    )


def j25_attainment_by_branch(w: Warehouse) -> DataFrame:
    g = w.mart_cumplimiento_metas.groupBy("nombre_sucursal").agg(F.sum("venta_neta").alias("v"), F.sum("meta_ventas").alias("m"))
    return g.select("nombre_sucursal", X.pct("v", "m").alias("cumplimiento_pct"))


def j26_returns_by_reason(w: Warehouse) -> DataFrame:
    return w.fct_devoluciones.groupBy("motivo").agg(X.sum_dec("monto_devuelto").alias("monto_devuelto"))


def j27_top_products_by_name(w: Warehouse, k: int = 10) -> DataFrame:
    p = w.dim_producto.select("sk_producto", "nombre_producto")
    g = _by_product(w).join(p, "sk_producto").groupBy("nombre_producto").agg(X.sum_dec("n").alias("venta_neta"))
    return g.orderBy(F.col("venta_neta").desc(), "nombre_producto").limit(k)


def j28_inventory_alerts(w: Warehouse) -> DataFrame:
    a = w.mart_alertas_inventario.filter((F.col("estado_stock") != "OK") | F.col("vence_en_60_dias"))
    return a.select(
        "nombre_sucursal", "sku", "nombre_producto", "stock_disponible", "stock_minimo", "unidades_promedio_mes",
        "meses_cobertura", "dias_para_vencer", "estado_stock",
    )


def d05_promotion_attribution(w: Warehouse) -> DataFrame:
    """Lines with an attributed promotion and the sum of winning promotion ids, per category."""
    l = w.int_ventas_lineas
    return l.groupBy("categoria").agg(
        F.count("id_promocion").alias("lineas_con_promocion"),
        F.sum("id_promocion").cast("bigint").alias("suma_id_promocion"),
        F.count(F.lit(1)).alias("lineas"),
    )
