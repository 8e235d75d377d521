"""Retail BI model (H20) and its KPIs.

Orders, order lines, deliveries, customers and products from the given
tables; text trimmed, unused columns dropped, delivery delay in days. KPIs
aggregate the line fact by its keys first and join the dimensions after.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.functions import exprs as X
from dwspark.plans.warehouse import Warehouse

# Fixed values of the retail role mapping.
SHIP_MODES = ["First Class", "Same Day", "Standard Class", "Second Class"]    # by o_orderkey % 4


class Retail:
    def __init__(self, w: Warehouse):
        self.w = w
        self.t = w.tables

    @cached_property
    def dim_customers(self) -> DataFrame:
        c = self.t.customer
        return c.select(F.col("c_custkey").alias("customer_id"), F.trim("c_name").alias("customer_name"),
                        F.col("c_mktsegment").alias("segment"))

    @cached_property
    def dim_products(self) -> DataFrame:
        p = self.t.part
        return p.select(F.col("p_partkey").alias("product_id"), F.trim("p_name").alias("product_name"),
                        F.trim("p_type").alias("category"), F.trim("p_brand").alias("sub_category"))

    @cached_property
    def fact_orders(self) -> DataFrame:
        o = self.t.orders
        d = F.col("o_orderdate").cast("date")
        k = (F.col("o_orderkey") % 4).cast("int")
        return o.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), d.alias("order_date"),
            F.date_add(d, (F.col("o_orderkey") % 5).cast("int")).alias("ship_date"),
            F.element_at(F.array(*[F.lit(m) for m in SHIP_MODES]), k + 1).alias("ship_mode"),
        )

    @cached_property
    def fact_order_details(self) -> DataFrame:
        """Line fact: sales = net line amount, profit = sales - quantity x base cost."""
        l = self.w.stg_venta_detalle
        p = self.w.stg_producto.select("id_producto", "costo_base")
        j = l.join(p, "id_producto", "left")
        return j.select(
            F.col("id_venta").alias("order_id"), F.col("id_producto").alias("product_id"),
            F.col("monto_neto").alias("sales"), F.col("cantidad").alias("quantity"), F.col("descuento_pct").alias("discount"),
            (F.col("monto_neto") - F.round(F.col("cantidad") * F.col("costo_base"), 2)).cast("decimal(14,2)").alias("profit"),
        )

    @cached_property
    def fact_deliveries(self) -> DataFrame:
        """Deliveries with the delay in days (B18); coordinates and cell index dropped."""
        e = self.w.fx.entrega().drop("latitud", "longitud", "celda")
        names = {"id_entrega": "delivery_id", "id_venta": "order_id", "fecha_estimada": "estimated_delivery_date", "fecha_real": "actual_delivery_date", "estatus": "status"}
        e = e.withColumns({"estatus": F.trim("estatus"), "dias_retraso": X.days_between("fecha_real", "fecha_estimada")})
        return e.withColumnsRenamed(names)


def h20_order_lines_model(r: Retail) -> DataFrame:
    """Line fact with its order, customer and product (4 relationships, D04)."""
    return (r.fact_order_details.join(r.fact_orders, "order_id").join(r.dim_customers, "customer_id")
            .join(r.dim_products, "product_id"))


def j46_totals(r: Retail) -> DataFrame:
    t = r.fact_order_details.agg(X.sum_dec("sales").alias("ventas_totales"), X.sum_dec("profit").alias("utilidad_total"))
    return t.withColumn("margen_pct", X.pct("utilidad_total", "ventas_totales"))


def j47_by_category(r: Retail) -> DataFrame:
    per_product = r.fact_order_details.groupBy("product_id").agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    g = per_product.join(r.dim_products.select("product_id", "category"), "product_id").groupBy("category").agg(
        X.sum_dec("s").alias("ventas"), X.sum_dec("p").alias("utilidad"))
    total = F.sum("ventas").over(Window.partitionBy())  # one row per category
    return g.select("category", "ventas", "utilidad", X.pct("utilidad", "ventas").alias("margen_pct"),
                    X.pct(F.col("ventas"), total).alias("participacion_pct"))


def j48_sales_by_month(r: Retail) -> DataFrame:
    per_order = r.fact_order_details.groupBy("order_id").agg(F.sum("sales").alias("s"))
    o = r.fact_orders.select("order_id", X.year_month("order_date").alias("anio_mes"))
    return per_order.join(o, "order_id").groupBy("anio_mes").agg(X.sum_dec("s").alias("ventas"))


def j49_sales_by_segment(r: Retail) -> DataFrame:
    per_order = r.fact_order_details.groupBy("order_id").agg(F.sum("sales").alias("s"))
    j = per_order.join(r.fact_orders.select("order_id", "customer_id"), "order_id").groupBy("customer_id").agg(F.sum("s").alias("s"))
    g = j.join(r.dim_customers.select("customer_id", "segment"), "customer_id").groupBy("segment").agg(X.sum_dec("s").alias("ventas"))
    total = F.sum("ventas").over(Window.partitionBy())
    return g.select("segment", "ventas", X.pct(F.col("ventas"), total).alias("participacion_pct"))


def j50_orders_by_ship_mode(r: Retail) -> DataFrame:
    return r.fact_orders.groupBy("ship_mode").agg(F.count(F.lit(1)).alias("ordenes"))


def j51_delivery_status(r: Retail) -> DataFrame:
    d = r.fact_deliveries
    g = d.groupBy("status").agg(F.count(F.lit(1)).alias("entregas"), F.sum("dias_retraso").alias("__d"))
    total = F.sum("entregas").over(Window.partitionBy())
    return g.select("status", "entregas", X.pct(F.col("entregas"), total).alias("participacion_pct"),
                    X.safe_div("__d", "entregas", 2).alias("dias_retraso_promedio"))


def retail_of(w: Warehouse) -> Retail:
    r = getattr(w, "_retail", None)
    if r is None:
        r = w._retail = Retail(w)
    return r


def queries() -> dict:
    fns = [h20_order_lines_model, j46_totals, j47_by_category, j48_sales_by_month, j49_sales_by_segment,
           j50_orders_by_ship_mode, j51_delivery_status]
    return {f.__name__: f for f in fns}
