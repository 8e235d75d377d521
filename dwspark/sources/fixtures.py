"""Role mapping: the warehouse's source relations derived from the given tables.

The retail warehouse expects transactional tables (branch, product, customer,
sale, sale line) and CSV extracts (promotions, returns, goals, inventory,
supplier prices). Here each of them is a lazy DataFrame computed from the
TPC-H-like test tables by fixed formulas, so every query's work grows with
the input. The same formulas exist as SQL in ``oracle/ctes.py``.

Joins here follow the data's shape: ``nation``/``region`` are tiny and
broadcast; ``lineitem``/``orders``/``part``/``customer`` are joined on their
keys and left to the planner (AQE turns a join into a broadcast at run time
only when the measured side is small).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.functions.exprs import dec
from dwspark.operators.joins import row_bound_ok
from dwspark.sources.store import Store
from dwspark.sources.tables import Tables

# Fixed values of the role mapping (shared with the SQL oracle).
CHANNELS = ["Tienda", "Mayorista", "Televenta", "Web"]                      # by o_orderkey % 4
UNITS = ["Caja ", " unidad", "PAQUETE", "botella"]                          # by p_size % 4
ORDER_STATUS = {"F": "Completada ", "O": "PENDIENTE", "P": "anulada"}       # dirty on purpose
RETURN_REASONS = [
    "Vencimiento cercano", "Error de despacho", "Cliente desistió",
    "Producto dañado", "Empaque defectuoso",
]                                                                           # by num_linea % 5
PROMOTIONS = [
    (1, "PROMO", "1996-01-01", "1996-03-31", "0.05"),
    (2, "PROMO", "1996-03-01", "1996-06-30", "0.15"),
    (3, "PROMO", "1996-03-15", "1996-04-15", "0.15"),
    (4, "ECONOMY", "1997-01-01", "1997-12-31", "0.10"),
    (5, "ECONOMY", "1997-06-01", "1997-06-30", "0.05"),
    (6, "SMALL", "1998-02-01", "1998-02-28", "0.20"),
    (7, "LARGE", "1999-01-01", "1999-06-30", "0.10"),
    (8, "LARGE", "1999-06-30", "1999-09-30", "0.12"),
    (9, "MEDIUM", "2000-05-05", "2000-05-05", "0.25"),
    (10, "STANDARD", "2001-01-01", "2001-12-31", "0.08"),
]
FLIGHT_STATUS = ["CANCELLED", "DIVERTED", "DELAYED", "DELAYED", "DELAYED", "DELAYED", "DELAYED"]  # id_venta % 20 in 0..6
GENDER_RAW = ["m", " M ", "Femenino", "F", "x", "No Binario", ""]           # by id_cliente % 7
DELIVERY_STATUS = ["Delivered", "Delayed", "Failed", "In Transit"]          # by o_orderkey % 4
DIRTY_GENDER = ["m", " M ", "f", "F ", ""]                                  # by c_custkey % 5
# Bounds used to prove broadcast sides small.
MAX_BRANCHES = 10_000


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based int index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def _mod(c: Column, n: int) -> Column:
    return (c % n).cast("int")


def written(fn):
    """A source whose joins and groupings are done once where there is a store: it is written when first asked for, and then read."""

    @wraps(fn)
    def get(self: "Fixtures") -> DataFrame:
        if self.store is None:
            return fn(self)
        if fn.__name__ not in self._frames:
            self._frames[fn.__name__] = self.store.frame(self.store.full(f"fuente_{fn.__name__}", fn(self)))
        return self._frames[fn.__name__]

    return get


class Fixtures:
    """Source relations of the warehouse derived from the test tables."""

    store: Store | None = None

    def __init__(self, tables: Tables):
        self.t = tables
        self.spark = tables.spark
        self._frames: dict[str, DataFrame] = {}

    @cached_property
    def branches_small(self) -> bool:
        """Branch count within MAX_BRANCHES: one LIMIT job per source directory."""
        return row_bound_ok(self.sucursal(), MAX_BRANCHES)

    def branch_side(self, df: DataFrame) -> DataFrame:
        """Broadcast a frame with one row per branch (+ at most one) when branches are proven few."""
        return F.broadcast(df) if self.branches_small else df

    # ---- OLTP roles -------------------------------------------------------
    def sucursal(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
            F.col("n_nationkey").alias("id_sucursal"),
            F.col("n_name").alias("nombre"),
            F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("ciudad"),
            F.col("r_name").alias("departamento"),
        )

    def producto(self) -> DataFrame:
        p = self.t.part
        precio = dec("p_retailprice", 12, 2)
        factor = (F.lit(55) + _mod(F.col("p_partkey"), 30)).cast("decimal(3,0)")
        costo = F.round(precio * factor * F.lit(0.01).cast("decimal(3,2)"), 2).cast("decimal(12,2)")
        return p.select(
            F.col("p_partkey").alias("id_producto"),
            F.concat(F.lit(" sku"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_name").alias("nombre"),
            F.col("p_type").alias("categoria"),
            F.col("p_brand").alias("marca"),
            _pick(UNITS, _mod(F.col("p_size"), 4)).alias("unidad_medida"),
            costo.alias("costo_base"),
            precio.alias("precio_lista"),
            (_mod(F.col("p_size"), 10) != 0).alias("activo"),
        )

    def cliente(self) -> DataFrame:
        c, n, r = self.t.customer, self.t.nation, self.t.region
        geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
        return c.join(geo, c.c_nationkey == geo.n_nationkey, "inner").select(
            F.col("c_custkey").alias("id_cliente"),
            F.concat(F.lit("NIT"), F.col("c_custkey").cast("string")).alias("nit"),
            F.col("c_name").alias("nombre"),
            F.col("c_mktsegment").alias("tipo_cliente"),
            F.col("n_name").alias("municipio"),
            F.col("r_name").alias("departamento"),
            F.date_add(F.lit("1995-01-01").cast("date"), _mod(F.col("c_custkey"), 700)).alias("fecha_alta"),
        )

    def venta(self) -> DataFrame:
        o = self.t.orders
        c = self.t.customer.select("c_custkey", "c_nationkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", F.lit(ORDER_STATUS["F"]))
            .when(F.col("o_orderstatus") == "O", F.lit(ORDER_STATUS["O"]))
            .when(F.col("o_orderstatus") == "P", F.lit(ORDER_STATUS["P"]))
        )
        return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
            F.col("o_orderkey").alias("id_venta"),
            F.col("o_orderdate").cast("date").alias("fecha"),
            F.col("o_custkey").alias("id_cliente"),
            F.col("c_nationkey").alias("id_sucursal"),
            _pick(CHANNELS, _mod(F.col("o_orderkey"), 4)).alias("canal"),
            F.col("o_orderpriority").alias("metodo_pago"),
            status.alias("estado"),
        )

    def linea(self) -> DataFrame:
        """Sale lines with a stable unique id (md5 of the full row key)."""
        li = self.t.lineitem
        prod = self.producto().select("id_producto", "precio_lista", F.col("categoria").alias("__categoria"))
        qty = F.col("l_quantity").cast("int")
        disc = dec("l_discount", 5, 4)
        id_detalle = F.md5(
            F.concat(
                F.col("l_orderkey").cast("string"), F.lit("-"),
                F.col("l_partkey").cast("string"), F.lit("-"),
                F.col("l_suppkey").cast("string"), F.lit("-"),
                F.col("l_linenumber").cast("string"), F.lit("-"),
                F.col("l_shipdate").cast("date").cast("string"), F.lit("-"),
                dec("l_extendedprice", 14, 2).cast("string"),
            )
        )
        return li.join(prod, li.l_partkey == prod.id_producto, "inner").select(
            id_detalle.alias("id_detalle"),
            F.col("l_orderkey").alias("id_venta"),
            F.col("l_partkey").alias("id_producto"),
            F.col("l_suppkey").alias("id_proveedor"),
            F.col("l_linenumber").alias("num_linea"),
            qty.alias("cantidad"),
            F.col("precio_lista").alias("precio_unitario"),
            disc.alias("descuento"),
            F.round(qty * F.col("precio_lista") * (F.lit(1) - disc), 2).cast("decimal(14,2)").alias("subtotal"),
            F.col("l_returnflag"),
            F.col("l_shipdate").cast("date").alias("fecha_envio"),
            F.col("__categoria"),  # carried for the flight role (pruned elsewhere)
        )

    # ---- CSV roles --------------------------------------------------------
    def promocion(self) -> DataFrame:
        schema = T.StructType([
            T.StructField("id_promocion", T.IntegerType(), False),
            T.StructField("categoria", T.StringType(), False),
            T.StructField("fecha_inicio", T.DateType(), False),
            T.StructField("fecha_fin", T.DateType(), False),
            T.StructField("porcentaje_descuento", T.StringType(), False),
        ])
        rows = [(i, c, _dt.date.fromisoformat(a), _dt.date.fromisoformat(b), p) for i, c, a, b, p in PROMOTIONS]
        # a promotion exists only for a category that the parts have
        first_word = F.split(F.trim("p_type"), " ").getItem(0)
        sold = self.t.part.select(first_word.alias("categoria")).distinct()
        df = self.spark.createDataFrame(rows, schema).join(sold, "categoria", "left_semi")
        return df.select(
            "id_promocion",
            F.concat(F.lit("Promo "), F.col("id_promocion").cast("string"), F.lit(" "), F.col("categoria")).alias("nombre"),
            "fecha_inicio",
            "fecha_fin",
            "categoria",
            dec("porcentaje_descuento", 5, 4).alias("porcentaje_descuento"),
        )

    @written
    def devolucion(self) -> DataFrame:
        ln = self.linea().filter(F.col("l_returnflag") == "R")
        v = self.venta().select(F.col("id_venta").alias("v_id"), F.col("fecha").alias("fecha_venta"))
        shift = F.when(_mod(F.col("id_venta"), 70) == 0, F.lit(-1)).otherwise(F.col("num_linea") * 3)
        qty = F.when(_mod(F.col("id_venta"), 50) == 0, F.col("cantidad") + 1).otherwise(
            F.greatest(F.lit(1), F.col("cantidad") - 3)
        )
        return ln.join(v, ln.id_venta == v.v_id, "inner").select(
            F.col("id_detalle").alias("id_devolucion"),
            F.date_add(F.col("fecha_venta"), shift.cast("int")).alias("fecha"),
            "id_venta",
            "id_producto",
            qty.cast("int").alias("cantidad"),
            _pick(RETURN_REASONS, _mod(F.col("num_linea"), 5)).alias("motivo"),
        )

    def meta(self) -> DataFrame:
        months = self.venta().select(F.substring(F.col("fecha").cast("string"), 1, 7).alias("periodo")).distinct()
        branches = self.branch_side(self.sucursal().select("id_sucursal"))
        m = F.substring(F.col("periodo"), 6, 2).cast("int")
        # months x branches is a grid by definition; both sides are bounded
        # (calendar months, branches), the output grows with months only.
        return months.crossJoin(branches).select(
            "periodo",
            "id_sucursal",
            (F.lit(50000) + F.lit(1000) * F.col("id_sucursal") + F.lit(500) * m).cast("decimal(14,2)").alias("meta_ventas"),
            (F.lit(1000) + F.lit(10) * F.col("id_sucursal")).cast("int").alias("meta_unidades"),
        )

    @written
    def inventario(self) -> DataFrame:
        """Stock at each month end of each product that its branch sold in that month: linear in the lines."""
        v = self.venta().select(F.col("id_venta").alias("v_id"), F.last_day("fecha").alias("fecha_corte"), "id_sucursal")
        ln = self.linea().select("id_venta", "id_producto")
        sold = ln.join(v, ln.id_venta == v.v_id).select("fecha_corte", "id_sucursal", "id_producto").distinct()
        p, n, m = F.col("id_producto"), F.col("id_sucursal"), F.month("fecha_corte")
        return sold.select(
            "fecha_corte",
            "id_sucursal",
            "id_producto",
            ((F.lit(7) * p + F.lit(13) * n + F.lit(5) * m) % 120).cast("int").alias("stock_disponible"),
            (F.lit(10) + p % 15).cast("int").alias("stock_minimo"),
            (F.lit(70) + n % 30).cast("int").alias("stock_maximo"),
            F.concat(F.lit("l"), p.cast("string"), F.lit("-"), n.cast("string")).alias("lote"),
            F.date_add(F.col("fecha_corte"), ((p + n + m) % 200 - 3).cast("int")).alias("fecha_vencimiento"),
        )

    @written
    def proveedor_precio(self) -> DataFrame:
        li = self.t.lineitem
        first = li.groupBy(F.col("l_suppkey").alias("id_proveedor"), F.col("l_partkey").alias("id_producto")).agg(
            F.min(F.col("l_shipdate").cast("date")).alias("fecha_vigencia")
        )
        s = self.t.supplier.select("s_suppkey", "s_name")
        prod = self.producto().select(F.col("id_producto").alias("pid"), "precio_lista")
        factor = (F.lit(50) + _mod(F.col("id_proveedor"), 40)).cast("decimal(3,0)")
        cost = F.round(F.col("precio_lista") * factor * F.lit(0.01).cast("decimal(3,2)"), 2).cast("decimal(12,2)")
        j = first.join(s, first.id_proveedor == s.s_suppkey, "inner").join(prod, F.col("id_producto") == F.col("pid"), "inner")
        return j.select(
            "id_proveedor",
            F.col("s_name").alias("proveedor"),
            "id_producto",
            F.when(_mod(F.col("id_proveedor"), 97) == 0, F.lit(None).cast("decimal(12,2)")).otherwise(cost).alias("costo_proveedor"),
            (F.lit(1) + _mod(F.col("id_proveedor"), 30)).cast("int").alias("plazo_dias"),
            "fecha_vigencia",
        )

    # ---- other projects' sources -----------------------------------------
    def vuelo(self) -> DataFrame:
        """Raw flight records (26 text-ish columns in the original file)."""
        ln = self.linea()
        v = self.venta().select(
            F.col("id_venta").alias("v_id"), "fecha", "id_cliente", "id_sucursal", "canal", "metodo_pago"
        )
        s = self.t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        j = (
            ln.join(v, ln.id_venta == v.v_id, "inner")
            .join(s, ln.id_proveedor == s.s_suppkey, "inner")
            .withColumnRenamed("__categoria", "categoria")
        )
        k20 = _mod(F.col("id_venta"), 20)
        k4 = _mod(F.col("id_venta"), 4)
        salida_txt = (
            F.when(k4 == 0, F.concat(F.date_format("fecha", "dd/MM/yyyy"), F.lit(" 08:30")))
            .when(k4 == 1, F.concat(F.date_format("fecha", "MM-dd-yyyy"), F.lit(" 09:15 PM")))
            .when(k4 == 2, F.concat(F.date_format("fecha", "dd-MM-yyyy"), F.lit(" 14:05")))
            .otherwise(F.concat(F.date_format("fecha", "yyyy-MM-dd"), F.lit(" 23:59")))
        )
        estado = F.when(k20 <= 6, _pick(FLIGHT_STATUS, F.least(k20, F.lit(6)))).otherwise(F.lit("ON_TIME"))
        return j.select(
            F.col("id_detalle").alias("id_vuelo"),
            F.col("id_proveedor").alias("cod_aerolinea"),
            F.col("s_name").alias("nom_aerolinea"),
            F.concat(F.lit("VN"), _mod(F.col("id_venta"), 1000).cast("string")).alias("num_vuelo"),
            F.col("s_nationkey").alias("origen"),
            F.col("id_sucursal").alias("destino"),
            salida_txt.alias("salida"),
            F.concat(F.date_format(F.date_sub(F.col("fecha"), _mod(F.col("id_cliente"), 30)), "yyyy-MM-dd"), F.lit(" 10:00"))
            .alias("fecha_compra"),
            (F.lit(40) + _mod(F.col("id_proveedor"), 300)).cast("int").alias("duracion"),
            estado.alias("estado"),
            F.when(estado == "DELAYED", F.lit(5) + _mod(F.col("id_producto"), 90)).otherwise(F.lit(0)).cast("int").alias("retraso"),
            F.col("categoria").alias("clase"),
            F.col("id_cliente").alias("uuid_pasajero"),
            _pick(GENDER_RAW, _mod(F.col("id_cliente"), 7)).alias("genero"),
            (F.lit(18) + _mod(F.col("id_cliente"), 60)).cast("string").alias("edad"),
            F.concat(F.lit("Pais "), F.col("id_sucursal").cast("string")).alias("pais"),
            "canal",
            "metodo_pago",
            F.col("subtotal").alias("precio_usd"),
            F.replace(F.col("subtotal").cast("string"), F.lit("."), F.lit(",")).alias("precio_orig"),
            _mod(F.col("cantidad"), 4).alias("equipaje"),
        )

    def entrega(self) -> DataFrame:
        o = self.t.orders
        d = F.col("o_orderdate").cast("date")
        return o.select(
            F.col("o_orderkey").alias("id_entrega"),
            F.col("o_orderkey").alias("id_venta"),
            F.date_add(d, 7).alias("fecha_estimada"),
            F.date_add(d, _mod(F.col("o_orderkey"), 15)).alias("fecha_real"),
            _pick(DELIVERY_STATUS, _mod(F.col("o_orderkey"), 4)).alias("estatus"),
            (F.lit(14) + _mod(F.col("o_orderkey"), 97) / 100).alias("latitud"),
            (F.lit(-90) - _mod(F.col("o_orderkey"), 89) / 100).alias("longitud"),
            _mod(F.col("o_orderkey"), 1000).alias("celda"),
        )

    def cliente_sucio(self) -> DataFrame:
        """Dirty customer file: spaces, case, comma decimals, mixed date formats."""
        c = self.t.customer
        n = self.t.nation.select("n_nationkey", "n_name")
        k = F.col("c_custkey")
        nombre = (
            F.when(_mod(k, 3) == 0, F.upper("c_name"))
            .when(_mod(k, 3) == 1, F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")))
            .otherwise(F.col("c_name"))
        )
        fecha = F.when(
            _mod(k, 2) == 0,
            F.date_add(F.lit("2026-01-13").cast("date"), _mod(k, 15)).cast("string"),
        ).otherwise(F.concat((F.lit(13) + _mod(k, 15)).cast("string"), F.lit("/02/2026")))
        bal = dec("c_acctbal", 12, 2).cast("string")
        gasto = (
            F.when(_mod(k, 10) == 0, F.lit(None).cast("string"))
            .when(_mod(k, 3) == 0, F.replace(bal, F.lit("."), F.lit(",")))
            .otherwise(bal)
        )
        ciudad = (
            F.when(_mod(k, 30) == 0, F.lit(None).cast("string"))
            .when(_mod(k, 31) == 0, F.lit(""))
            .otherwise(F.concat(F.lit(" "), F.lower("n_name")))
        )
        return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
            k.alias("id_cliente"),
            nombre.alias("nombre"),
            _pick(DIRTY_GENDER, _mod(k, 5)).alias("genero"),
            fecha.alias("fecha_registro"),
            gasto.alias("gasto_q"),
            ciudad.alias("ciudad"),
            F.col("c_mktsegment").alias("categoria"),
        )
