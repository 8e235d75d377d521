"""The retail warehouse: staging (H00), intermediate, dimensions (H01-H07),
facts (H08-H13) and marts (H14, H15), as lazy DataFrames.

Plan shape (what each layer costs at scale):

* staging: projections only - no shuffle, pushed into the scans;
* ``int_ventas_lineas``: sale lines x sale header (shuffle on ``id_venta``,
  or co-located when both are bucketed by it), x product (shuffle on
  ``id_producto`` unless the product side is proven small), then one
  broadcast equi-join on (category, day) against the resolved promotion
  calendar - no fact-sized range join or per-line ranking;
* facts compute every surrogate key from the natural key (md5 / YYYYMMDD)
  instead of joining the dimension for it; only membership is checked (a
  key-only left join, or the join the fact needs anyway for cost/category),
  and a missing member maps to the unknown key; the calendar key falls back
  to -1 outside the calendar range by an expression, no join at all;
* queries aggregate the fact first and join dimensions after, so joins see
  one row per group instead of one per line.

A shared warehouse (``Warehouse.of``) writes the facts and marts once and
reads them from then on; ``build`` publishes them as one state of a store.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.functions import exprs as X
from dwspark.functions.keys import sk, sk_date, sk_date_in_range, sk_unknown
from dwspark.operators.joins import attribute_promotion, enrich_returns, row_bound_ok
from dwspark.session import scratch_path
from dwspark.sources.fixtures import Fixtures
from dwspark.sources.store import Store
from dwspark.sources.tables import Tables

CALENDAR_MAX_ROWS = 40_000          # bound for broadcasting the calendar
SMALL_DIM_ROWS = 100_000            # branch, junk and promotion dimensions
UNKNOWN_LABEL = "Desconocido"
UNKNOWN_LABEL_F = "Desconocida"
NO_PROMOTION = "Sin promoción"
EXPIRY_ALERT_DAYS = 60
RECENT_MONTHS = 3


def stored(fn):
    """A frame that a shared warehouse writes once, when it is first asked for, and then reads."""

    def get(self: "Warehouse") -> DataFrame:
        df = fn(self)
        return df if self.store is None else self.store.frame(self.store.full(fn.__name__, df))

    get.__name__, get.__doc__ = fn.__name__, fn.__doc__
    return cached_property(get)


class Warehouse:
    """All warehouse frames for one source directory; each built once per instance.

    Frames are lazy, immutable plans: ``Warehouse.of(spark, dir)`` shares one
    instance per session and directory (like a catalog of views), so a second
    query does not rebuild and re-analyse the same plans. The shared instance
    also writes the sale lines, the facts and marts of ``stored`` and the
    sources that are joined or grouped (``fixtures.written``) once, under
    ``spark.checkpoint.dir``, when a query first asks for it: all later queries
    read the written table, and a lost executor re-reads it.
    """

    store: Store | None = None

    _shared: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        w = cls._shared.get(key)
        if w is None:
            w = cls._shared[key] = cls(spark, sf_dir)
            w.store = w.fx.store = Store(spark, scratch_path(spark, "star"))
        return w

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = Tables(spark, sf_dir)
        self.fx = Fixtures(self.tables)
        self._overridden: frozenset[str] | set[str] = frozenset()

    def copy(self, **frames: DataFrame) -> "Warehouse":
        """Another warehouse over the same sources in which ``frames`` stand for the frames of their names."""
        other = Warehouse(self.spark, self.sf_dir)
        other.fx = self.fx
        other.__dict__.update({n: f for n, f in self.__dict__.items() if n in self._overridden})
        other._overridden = self._overridden | set(frames)
        other.__dict__.update(frames)
        return other

    # ============================================================ proven sizes
    @cached_property
    def calendar_range(self) -> tuple[_dt.date, _dt.date]:
        """Days of dim_fecha: from the year of the first order or shipment (a day earlier, for returns) to the end of the year after the last one, for expiries."""
        days = [self.tables.orders.select(F.col("o_orderdate").cast("date").alias("d")), self.tables.lineitem.select(F.col("l_shipdate").cast("date").alias("d"))]
        lo, hi = days[0].unionByName(days[1]).agg(F.min("d"), F.max("d")).first()
        if lo is None:
            raise ValueError("no order or shipment date: the calendar has no range")
        return (lo - _dt.timedelta(days=1)).replace(month=1, day=1), _dt.date(hi.year + 1, 12, 31)

    def calendar(self, *cols: str) -> DataFrame:
        """Columns of dim_fecha, broadcast: its row count is known from its range."""
        c = self.dim_fecha.select(*cols)
        lo, hi = self.calendar_range
        return F.broadcast(c) if (hi - lo).days + 2 <= CALENDAR_MAX_ROWS else c

    def branch_side(self, df: DataFrame) -> DataFrame:
        """A frame with one row per branch (staging or dimension), broadcast when branches are proven few."""
        return self.fx.branch_side(df)

    @cached_property
    def promotions_small(self) -> bool:
        """Promotions within SMALL_DIM_ROWS (with the unknown member): one count per warehouse."""
        return row_bound_ok(self.stg_promociones, SMALL_DIM_ROWS - 1)

    def promotion_side(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.promotions_small else df

    # =================================================================== staging
    @cached_property
    def stg_sucursal(self) -> DataFrame:
        s = self.fx.sucursal()
        return s.select(
            "id_sucursal",
            F.trim("nombre").alias("nombre_sucursal"),
            F.trim("ciudad").alias("ciudad"),
            F.trim("departamento").alias("departamento"),
        )

    @cached_property
    def stg_producto(self) -> DataFrame:
        p = self.fx.producto()
        return p.select(
            "id_producto",
            F.upper(F.trim("sku")).alias("sku"),
            F.trim("nombre").alias("nombre_producto"),
            F.trim("categoria").alias("categoria"),
            F.trim("marca").alias("marca"),
            F.lower(F.trim("unidad_medida")).alias("unidad_medida"),
            "costo_base",
            "precio_lista",
            "activo",
        )

    @cached_property
    def stg_categoria(self) -> DataFrame:
        """Categories of the products; the id is the md5 of the name."""
        return self.stg_producto.select("categoria").distinct().select(F.md5("categoria").alias("id_categoria"), "categoria")

    @cached_property
    def stg_marca(self) -> DataFrame:
        return self.stg_producto.select("marca").distinct().select(F.md5("marca").alias("id_marca"), "marca")

    @cached_property
    def stg_cliente(self) -> DataFrame:
        c = self.fx.cliente()
        return c.select(
            "id_cliente",
            F.trim("nit").alias("nit"),
            F.trim("nombre").alias("nombre_cliente"),
            F.trim("tipo_cliente").alias("tipo_cliente"),
            F.trim("municipio").alias("municipio"),
            F.trim("departamento").alias("departamento"),
            "fecha_alta",
        )

    @cached_property
    def stg_venta(self) -> DataFrame:
        v = self.fx.venta()
        return v.select(
            "id_venta",
            F.col("fecha").alias("fecha_venta"),
            "id_cliente",
            "id_sucursal",
            F.trim("canal").alias("canal"),
            F.trim("metodo_pago").alias("metodo_pago"),
            F.upper(F.trim("estado")).alias("estado_venta"),
        )

    @cached_property
    def stg_venta_detalle(self) -> DataFrame:
        d = self.fx.linea()
        return d.select(
            "id_detalle",
            "id_venta",
            "id_producto",
            "cantidad",
            "precio_unitario",
            F.col("descuento").alias("descuento_pct"),
            F.col("subtotal").alias("monto_neto"),
        )

    @cached_property
    def stg_promociones(self) -> DataFrame:
        p = self.fx.promocion()
        return p.select(
            F.col("id_promocion").cast("int"),
            F.col("nombre").alias("nombre_promocion"),
            F.col("fecha_inicio").cast("date"),
            F.col("fecha_fin").cast("date"),
            "categoria",
            F.col("porcentaje_descuento").cast("decimal(5,4)"),
        )

    @cached_property
    def stg_devoluciones(self) -> DataFrame:
        d = self.fx.devolucion()
        return d.select(
            "id_devolucion",
            F.col("fecha").cast("date").alias("fecha_devolucion"),
            F.col("id_venta").cast("bigint"),
            F.col("id_producto").cast("bigint"),
            F.col("cantidad").cast("int").alias("cantidad_devuelta"),
            "motivo",
        )

    @cached_property
    def stg_metas(self) -> DataFrame:
        m = self.fx.meta()
        return m.select(
            F.col("periodo").alias("anio_mes"),
            F.to_date(F.concat(F.col("periodo"), F.lit("-01"))).alias("fecha_mes"),
            F.col("id_sucursal").cast("int"),
            F.col("meta_ventas").cast("decimal(14,2)"),
            F.col("meta_unidades").cast("int"),
        )

    @cached_property
    def stg_inventario(self) -> DataFrame:
        i = self.fx.inventario()
        return i.select(
            F.col("fecha_corte").cast("date"),
            F.col("id_sucursal").cast("int"),
            F.col("id_producto").cast("bigint"),
            F.col("stock_disponible").cast("int"),
            F.col("stock_minimo").cast("int"),
            F.col("stock_maximo").cast("int"),
            F.upper("lote").alias("lote"),
            F.col("fecha_vencimiento").cast("date"),
        )

    @cached_property
    def stg_proveedores_precios(self) -> DataFrame:
        p = self.fx.proveedor_precio()
        return p.select(
            F.col("id_proveedor").cast("bigint"),
            F.col("proveedor").alias("nombre_proveedor"),
            F.col("id_producto").cast("bigint"),
            F.col("costo_proveedor").cast("decimal(12,2)"),
            F.col("plazo_dias").cast("short"),
            F.col("fecha_vigencia").cast("date"),
        )

    # ============================================================== dimensions
    @cached_property
    def dim_fecha(self) -> DataFrame:
        """Every day of the calendar range + the unknown member."""
        days = self.spark.range(1).select(
            F.explode(F.sequence(*[F.lit(d.isoformat()).cast("date") for d in self.calendar_range])).alias("fecha")
        )
        parts = X.calendar_parts("fecha")
        real = days.select(sk_date("fecha").alias("sk_fecha"), "fecha", *[v.alias(k) for k, v in parts.items()])
        unknown = self._unknown_row(real, sk_fecha=-1, nombre_mes=UNKNOWN_LABEL, nombre_dia=UNKNOWN_LABEL)
        return real.unionByName(unknown)

    @cached_property
    def dim_sucursal(self) -> DataFrame:
        s = self.stg_sucursal
        real = s.select(sk("id_sucursal").alias("sk_sucursal"), F.col("id_sucursal").cast("bigint"),
                        "nombre_sucursal", "ciudad", "departamento")
        return real.unionByName(self._unknown_row(real, sk_sucursal=None, id_sucursal=-1, nombre_sucursal=UNKNOWN_LABEL_F))

    @cached_property
    def int_productos(self) -> DataFrame:
        p = self.stg_producto
        return p.withColumn("margen_lista_pct", X.list_margin("precio_lista", "costo_base"))

    @cached_property
    def dim_producto(self) -> DataFrame:
        p = self.int_productos
        real = p.select(
            sk("id_producto").alias("sk_producto"), F.col("id_producto").cast("bigint"), "sku", "nombre_producto",
            "categoria", "marca", "unidad_medida", "costo_base", "precio_lista",
            F.col("margen_lista_pct").cast("decimal(7,4)"), "activo",
        )
        return real.unionByName(self._unknown_row(
            real, sk_producto=None, id_producto=-1, nombre_producto=UNKNOWN_LABEL,
            categoria=UNKNOWN_LABEL_F, marca=UNKNOWN_LABEL_F))

    @cached_property
    def dim_cliente(self) -> DataFrame:
        c = self.stg_cliente
        real = c.select(sk("id_cliente").alias("sk_cliente"), F.col("id_cliente").cast("bigint"), "nit",
                        "nombre_cliente", "tipo_cliente", "municipio", "departamento", "fecha_alta")
        return real.unionByName(self._unknown_row(
            real, sk_cliente=None, id_cliente=-1, nombre_cliente=UNKNOWN_LABEL, tipo_cliente=UNKNOWN_LABEL))

    @cached_property
    def dim_proveedor(self) -> DataFrame:
        """Suppliers exist only in the price list: one row per id, max(name)."""
        pp = self.stg_proveedores_precios
        real = pp.groupBy("id_proveedor").agg(F.max("nombre_proveedor").alias("nombre_proveedor"))
        real = real.select(sk("id_proveedor").alias("sk_proveedor"), "id_proveedor", "nombre_proveedor")
        return real.unionByName(self._unknown_row(real, sk_proveedor=None, id_proveedor=-1, nombre_proveedor=UNKNOWN_LABEL))

    @cached_property
    def dim_promocion(self) -> DataFrame:
        pr = self.stg_promociones
        real = pr.select(
            sk("id_promocion").alias("sk_promocion"), "id_promocion", "nombre_promocion", "categoria",
            "fecha_inicio", "fecha_fin", "porcentaje_descuento",
            (F.datediff("fecha_fin", "fecha_inicio") + 1).alias("duracion_dias"),
        )
        unknown = self._unknown_row(real, sk_promocion=None, id_promocion=-1, nombre_promocion=NO_PROMOTION,
                                    porcentaje_descuento=0)
        return real.unionByName(unknown)

    @cached_property
    def dim_condicion_venta(self) -> DataFrame:
        """Junk dimension: distinct channel x payment x status."""
        v = self.stg_venta.select("canal", "metodo_pago", "estado_venta").distinct()
        real = v.select(sk("canal", "metodo_pago", "estado_venta").alias("sk_condicion_venta"),
                        "canal", "metodo_pago", "estado_venta")
        return real.unionByName(self._unknown_row(
            real, sk_condicion_venta=None, canal=UNKNOWN_LABEL, metodo_pago=UNKNOWN_LABEL, estado_venta=UNKNOWN_LABEL))

    def _unknown_row(self, like: DataFrame, **values) -> DataFrame:
        """One-row frame with the schema of ``like``; sk columns default to md5('-1')."""
        cols = []
        for f in like.schema.fields:
            if f.name.startswith("sk_") and values.get(f.name, "x") is None:
                cols.append(sk_unknown().cast(f.dataType).alias(f.name))
            elif f.name in values:
                cols.append(F.lit(values[f.name]).cast(f.dataType).alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        return self.spark.range(1).select(*cols)

    # ============================================================ intermediate
    @stored
    def int_ventas_lineas(self) -> DataFrame:
        """One row per sale line: header, unit cost, promotion, measures.

        Membership flags (``__has_*``) record whether the line's customer,
        branch and product exist in their sources; facts use them to fall back
        to the unknown member exactly like a left join on the dimension would.
        The customer check runs on sale headers (4x fewer rows than lines).
        """
        d = self.stg_venta_detalle
        cli = self.stg_cliente.select("id_cliente", F.lit(True).alias("__has_cliente"))
        suc = self.branch_side(self.stg_sucursal.select("id_sucursal", F.lit(True).alias("__has_sucursal")))
        v = self.stg_venta.join(cli, "id_cliente", "left").join(suc, "id_sucursal", "left")
        p = self.int_productos.select(
            "id_producto", "categoria", F.col("costo_base").alias("costo_unitario"), F.lit(True).alias("__has_producto")
        )
        # the lines come dealt by product, from the join that gives them their price: with the product first they are dealt once more only
        lines = d.join(p, "id_producto", "left").join(v, "id_venta", "left")
        lines = attribute_promotion(lines, self.stg_promociones, key="categoria", date_col="fecha_venta", days=self.calendar_range)
        m = X.line_measures()
        return lines.select(
            "id_detalle", "id_venta", "fecha_venta", "id_cliente", "id_sucursal", "canal", "metodo_pago",
            "estado_venta", "id_producto", "categoria", "cantidad", "precio_unitario", "descuento_pct",
            "monto_neto", "costo_unitario", "id_promocion",
            m["monto_bruto"].alias("monto_bruto"),
            m["monto_descuento"].alias("monto_descuento"),
            m["costo_total"].alias("costo_total"),
            m["margen_bruto"].alias("margen_bruto"),
            X.valid_sale("estado_venta").alias("es_venta_valida"),
            F.coalesce("__has_cliente", F.lit(False)).alias("__has_cliente"),
            F.coalesce("__has_sucursal", F.lit(False)).alias("__has_sucursal"),
            F.coalesce("__has_producto", F.lit(False)).alias("__has_producto"),
        )

    @cached_property
    def int_devoluciones(self) -> DataFrame:
        return enrich_returns(self.stg_devoluciones, self.int_ventas_lineas, {"id_cliente": "__has_cliente", "id_sucursal": "__has_sucursal"})

    @cached_property
    def int_costos_proveedor(self) -> DataFrame:
        """Supplier cost vs product base cost; cheapest flag per product."""
        from dwspark.operators.windows import is_min_per_key

        pp = self.stg_proveedores_precios
        p = self.stg_producto.select(
            "id_producto", F.col("costo_base").alias("costo_base_producto"), F.lit(True).alias("__has_producto")
        )
        j = pp.join(p, "id_producto", "left")
        j = j.withColumn("diferencia_vs_costo_base", (F.col("costo_proveedor") - F.col("costo_base_producto")).cast("decimal(12,2)"))
        return is_min_per_key(j, ["id_producto"], "costo_proveedor", "es_proveedor_mas_barato")

    # ==================================================================== facts
    def _sk_fecha(self, c) -> F.Column:
        return sk_date_in_range(c, *[d.isoformat() for d in self.calendar_range])

    @staticmethod
    def _sk_nullable(*cols) -> F.Column:
        """sk of the natural key, unknown member when any part is NULL (no dimension row matches NULL)."""
        any_null = None
        for c in cols:
            cond = F.col(c).isNull()
            any_null = cond if any_null is None else (any_null | cond)
        return F.when(any_null, sk_unknown()).otherwise(sk(*cols))

    @staticmethod
    def _sk_if(flag: str, *cols) -> F.Column:
        """sk of the natural key when the dimension row exists, else the unknown member."""
        return F.when(F.coalesce(F.col(flag), F.lit(False)), sk(*cols)).otherwise(sk_unknown())

    def _with_presence(self, df: DataFrame, dim_keys: DataFrame, key: str, flag: str, branches: bool = False) -> DataFrame:
        k = dim_keys.select(F.col(key), F.lit(True).alias(flag))
        if branches:
            k = self.branch_side(k)
        return df.join(k, key, "left")

    @cached_property
    def fct_ventas(self) -> DataFrame:
        """Grain = sale line (H09). Foreign keys are computed, not looked up.

        A projection of the lines, which a shared warehouse writes: their keys
        are computed by the queries that read them, not written beside them.
        """
        l = self.int_ventas_lineas
        return l.select(
            "id_detalle",
            "id_venta",
            self._sk_fecha("fecha_venta").alias("sk_fecha"),
            self._sk_if("__has_cliente", "id_cliente").alias("sk_cliente"),
            self._sk_if("__has_producto", "id_producto").alias("sk_producto"),
            self._sk_if("__has_sucursal", "id_sucursal").alias("sk_sucursal"),
            self._sk_nullable("canal", "metodo_pago", "estado_venta").alias("sk_condicion_venta"),
            self._sk_nullable("id_promocion").alias("sk_promocion"),
            "cantidad",
            F.col("precio_unitario").cast("decimal(12,2)"),
            F.col("descuento_pct").cast("decimal(5,4)"),
            F.col("monto_bruto").cast("decimal(14,2)"),
            F.col("monto_descuento").cast("decimal(14,2)"),
            F.col("monto_neto").cast("decimal(14,2)"),
            F.col("costo_unitario").cast("decimal(12,2)"),
            F.col("costo_total").cast("decimal(14,2)"),
            F.col("margen_bruto").cast("decimal(14,2)"),
            "es_venta_valida",
        )

    @stored
    def fct_devoluciones(self) -> DataFrame:
        """Grain = one return; the calendar plays two roles."""
        # customer and branch come from the sold lines, which know whether they exist
        d = self._with_presence(self.int_devoluciones, self.stg_producto, "id_producto", "__has_producto")
        return d.select(
            "id_devolucion",
            "id_venta",
            self._sk_fecha("fecha_devolucion").alias("sk_fecha"),
            self._sk_fecha("fecha_venta").alias("sk_fecha_venta"),
            self._sk_if("__has_producto", "id_producto").alias("sk_producto"),
            self._sk_if("__has_cliente", "id_cliente").alias("sk_cliente"),
            self._sk_if("__has_sucursal", "id_sucursal").alias("sk_sucursal"),
            "motivo",
            "cantidad_devuelta",
            "precio_neto_unitario",
            "monto_devuelto",
            "dias_desde_venta",
        )

    @stored
    def fct_inventario_mensual(self) -> DataFrame:
        """Periodic snapshot (H11): stock quantities are semi-additive."""
        i = self.stg_inventario
        p = self.stg_producto.select("id_producto", "costo_base", F.lit(True).alias("__has_producto"))
        j = i.join(p, "id_producto", "left")
        j = self._with_presence(j, self.stg_sucursal, "id_sucursal", "__has_sucursal", branches=True)
        return j.select(
            sk("fecha_corte", "id_sucursal", "id_producto").alias("sk_inventario"),
            self._sk_fecha("fecha_corte").alias("sk_fecha_corte"),
            self._sk_if("__has_sucursal", "id_sucursal").alias("sk_sucursal"),
            self._sk_if("__has_producto", "id_producto").alias("sk_producto"),
            self._sk_fecha("fecha_vencimiento").alias("sk_fecha_vencimiento"),
            "lote",
            "stock_disponible",
            "stock_minimo",
            "stock_maximo",
            F.col("costo_base").cast("decimal(12,2)").alias("costo_unitario"),
            (F.col("stock_disponible") * F.col("costo_base")).cast("decimal(14,2)").alias("valor_inventario"),
            F.datediff("fecha_vencimiento", "fecha_corte").alias("dias_para_vencer"),
            (F.col("stock_disponible") == 0).alias("es_sin_stock"),
            (F.col("stock_disponible") < F.col("stock_minimo")).alias("es_bajo_minimo"),
            (F.col("stock_disponible") > F.col("stock_maximo")).alias("es_sobre_maximo"),
        )

    @stored
    def fct_metas_ventas(self) -> DataFrame:
        """Grain = month x branch."""
        m = self._with_presence(self.stg_metas, self.stg_sucursal, "id_sucursal", "__has_sucursal", branches=True)
        return m.select(
            self._sk_fecha("fecha_mes").alias("sk_fecha_mes"),
            self._sk_if("__has_sucursal", "id_sucursal").alias("sk_sucursal"),
            "anio_mes",
            "meta_ventas",
            "meta_unidades",
        )

    @stored
    def fct_costos_proveedor(self) -> DataFrame:
        """Grain = supplier x product x effective date."""
        c = self.int_costos_proveedor
        return c.select(
            self._sk_nullable("id_proveedor").alias("sk_proveedor"),
            self._sk_if("__has_producto", "id_producto").alias("sk_producto"),
            self._sk_fecha("fecha_vigencia").alias("sk_fecha_vigencia"),
            "costo_proveedor",
            "plazo_dias",
            F.col("costo_base_producto").cast("decimal(12,2)"),
            "diferencia_vs_costo_base",
            "es_proveedor_mas_barato",
        )

    # ==================================================================== marts
    @stored
    def mart_cumplimiento_metas(self) -> DataFrame:
        """One row per goal: sales vs goal by branch and month."""
        cal = self.calendar("sk_fecha", "anio_mes")
        f = self.fct_ventas.filter("es_venta_valida")
        # distinct sales per (branch, month) without Expand: group by the sale first
        per_sale = f.join(cal, "sk_fecha").groupBy("sk_sucursal", "anio_mes", "id_venta").agg(
            F.sum("monto_neto").alias("n"), F.sum("cantidad").alias("u"), F.sum("margen_bruto").alias("m")
        )
        ventas = per_sale.groupBy("sk_sucursal", "anio_mes").agg(
            X.sum_dec("n").alias("venta_neta"),
            X.sum_int("u").alias("unidades_vendidas"),
            F.count(F.lit(1)).alias("num_ventas"),
            X.sum_dec("m").alias("margen_bruto"),
        )
        dv = self.fct_devoluciones.join(cal, "sk_fecha").groupBy("sk_sucursal", "anio_mes").agg(
            X.sum_dec("monto_devuelto").alias("monto_devuelto"),
            X.sum_int("cantidad_devuelta").alias("unidades_devueltas"),
        )
        s = self.branch_side(self.dim_sucursal.select("sk_sucursal", "id_sucursal", "nombre_sucursal"))
        m = self.fct_metas_ventas.join(s, "sk_sucursal", "inner")
        j = m.join(ventas, ["sk_sucursal", "anio_mes"], "left").join(dv, ["sk_sucursal", "anio_mes"], "left")
        vn = F.coalesce("venta_neta", F.lit(0).cast("decimal(38,2)"))
        md = F.coalesce("monto_devuelto", F.lit(0).cast("decimal(38,2)"))
        uv = F.coalesce("unidades_vendidas", F.lit(0).cast("bigint"))
        return j.select(
            "anio_mes",
            "id_sucursal",
            "nombre_sucursal",
            "meta_ventas",
            "meta_unidades",
            vn.alias("venta_neta"),
            md.alias("monto_devuelto"),
            (vn - md).cast("decimal(38,2)").alias("venta_neta_menos_devoluciones"),
            uv.alias("unidades_vendidas"),
            F.coalesce("num_ventas", F.lit(0).cast("bigint")).alias("num_ventas"),
            F.coalesce("margen_bruto", F.lit(0).cast("decimal(38,2)")).alias("margen_bruto"),
            X.safe_div(vn, "meta_ventas", 4).alias("pct_cumplimiento_ventas"),
            X.safe_div(uv, "meta_unidades", 4).alias("pct_cumplimiento_unidades"),
            (vn >= F.col("meta_ventas")).alias("cumplio_meta_ventas"),
        )

    @cached_property
    def ultimo_corte(self) -> DataFrame:
        """One-row frame with the last inventory cut-off."""
        cal = self.calendar("sk_fecha", "fecha")
        i = self.fct_inventario_mensual.select(F.col("sk_fecha_corte").alias("sk_fecha"))
        # partial max per task, then one row: no shuffle of the snapshot rows
        return i.join(cal, "sk_fecha").agg(F.max("fecha").alias("fecha_corte"))

    @stored
    def mart_alertas_inventario(self) -> DataFrame:
        """Last cut-off stock with 3-month average sales and cover.

        The last cut-off is a scalar subquery (computed once, inlined as a
        value); sales are filtered to the 3-month window before aggregating.
        """
        cal = self.calendar("sk_fecha", "fecha")
        last = self.ultimo_corte.scalar()
        inv = (
            self.fct_inventario_mensual.join(cal.withColumnRenamed("sk_fecha", "sk_fecha_corte"), "sk_fecha_corte")
            .withColumnRenamed("fecha", "fecha_corte")
            .filter(F.col("fecha_corte") == last)
        )
        recent = (
            self.fct_ventas.filter("es_venta_valida")
            .join(cal, "sk_fecha")
            .filter((F.col("fecha") > X.months_back(last, RECENT_MONTHS)) & (F.col("fecha") <= last))
            .groupBy("sk_sucursal", "sk_producto")
            .agg(F.sum("cantidad").cast("bigint").alias("__units"))
        )
        s = self.branch_side(self.dim_sucursal.select("sk_sucursal", "nombre_sucursal"))
        p = self.dim_producto.select("sk_producto", "sku", "nombre_producto", "categoria")
        j = inv.join(s, "sk_sucursal", "inner").join(p, "sk_producto", "inner").join(recent, ["sk_sucursal", "sk_producto"], "left")
        avg3 = F.col("__units").cast("double") / F.lit(3.0)
        avg3_dec = F.round(avg3.cast("decimal(24,8)"), 2).cast("decimal(18,2)")
        return j.select(
            "fecha_corte",
            "nombre_sucursal",
            "sku",
            "nombre_producto",
            "categoria",
            "stock_disponible",
            "stock_minimo",
            "stock_maximo",
            "valor_inventario",
            "dias_para_vencer",
            F.coalesce(avg3_dec, F.lit(0).cast("decimal(18,2)")).alias("unidades_promedio_mes"),
            F.round((F.col("stock_disponible").cast("double") / F.nullif(avg3, F.lit(0.0))).cast("decimal(24,8)"), 2)
            .cast("decimal(18,2)").alias("meses_cobertura"),
            X.stock_status().alias("estado_stock"),
            (F.col("dias_para_vencer") <= EXPIRY_ALERT_DAYS).alias("vence_en_60_dias"),
        )
