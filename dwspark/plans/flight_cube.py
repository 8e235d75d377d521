"""Mergeable flight measures (J29-J40, J43, J45) and the report pages' slicers.

The cube holds, for each month, airline, class and status, the additive parts
of all measures, and the passengers as exact bitmaps: passengers are numbered,
and a row holds the bitmap of one run of 64 numbers, a word. A cell of few
passengers so costs a few words, and the cube never has more rows than the fact.
Bitmaps of any rows merge by OR, so a distinct count of any grouping of these
four comes from the cube, where ``count_distinct`` has to read the fact again for each.

The flights and the cube are written once a session, partitioned by month: a
slicer on the period reaches the written files as dynamic partition pruning.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.functions import exprs as X
from dwspark.operators.joins import broadcast_bounded
from dwspark.plans import flights as FL
from dwspark.plans.warehouse import SMALL_DIM_ROWS, Warehouse
from dwspark.session import scratch_path
from dwspark.sources.store import Store

MONTH, BUCKET, BITS = FL.MONTH, "tramo", "pasajeros"
WORD = 64  # passengers in a row's bitmap
SLOTS = 4096  # passengers are dealt to slots by hash and ranked within them
CUBE_KEYS = [MONTH, "id_aerolinea", "id_clase_sk", "estado_vuelo"]
ADDITIVE = ["vuelos", "usd", "usd_operativo", "operativos", "equipaje", "cancelados", "operados", "retrasados", "retraso"]


@dataclass(frozen=True)
class Slicers:
    """What a page is filtered by; None leaves a slicer open."""

    aerolinea: str | None = None
    anio: int | None = None
    clase: str | None = None
    estado: str | None = None


class Cube:
    def __init__(self, f: FL.Flights):
        self.f, self.spark = f, f.spark
        self.store = f.w.store or Store(f.spark, scratch_path(f.spark, "flights"))

    @cached_property
    def fact(self) -> DataFrame:
        """The flight fact by month of departure; the flights it is a projection of are written once."""
        return self.f.fact_by_month if self.f.w.store else self.store.frame(self.store.full("hechos_vuelos", self.f.fact_by_month, [MONTH]))

    @cached_property
    def months(self) -> DataFrame:
        """One row a month of the fact, with its year; a month is a partition, so they are few."""
        m = self.fact.select(MONTH).distinct()
        months = m.select(MONTH, F.floor(F.col(MONTH) / 100).cast("int").alias("anio"), (F.col(MONTH) % 100).cast("int").alias("mes"))
        return self.store.frame(self.store.full("meses", months))

    @staticmethod
    def numbered(rows: DataFrame) -> DataFrame:
        """Rows with their passenger's ``numero``: the rank among the passengers of its slot, after the slot's number; ranks are consecutive, so words are dense."""
        rows = rows.withColumn("__slot", F.pmod(F.xxhash64("id_pasajero"), F.lit(SLOTS)))
        rank = F.dense_rank().over(Window.partitionBy("__slot").orderBy("id_pasajero")) - 1
        return rows.withColumn("numero", F.shiftleft("__slot", 40) + rank)

    @cached_property
    def passengers(self) -> DataFrame:
        """The number of each passenger, as the cube has it."""
        numbered = self.numbered(self.fact.select("id_pasajero").distinct()).select("id_pasajero", "numero")
        return self.store.frame(self.store.full("numeros", numbered))

    @cached_property
    def cells(self) -> DataFrame:
        """The cube: ``CUBE_KEYS``, the word of passenger numbers, its bitmap, and additive measures, written once.

        The fact is dealt by the passengers' slots once: numbers are found and
        cells are added up where the rows are then.
        """
        st = F.col("estado_vuelo")
        open_ = ~st.eqNullSafe(F.lit(FL.CANCELLED))  # blank status counts as not cancelled
        operated = st.isin(*FL.OPERATED)
        # keys are md5 in hex: half as long on their way
        keys = ["id_pasajero", "id_aerolinea"]
        short = self.fact.select(*[F.unhex(k).alias(k) for k in keys], MONTH, "id_clase_sk", "estado_vuelo", "precio_usd", "equipaje", "retraso_minutos")
        word = F.shiftright("numero", 6).alias(BUCKET)
        bit = F.expr(f"shiftleft(1L, cast(numero % {WORD} as int))")
        cells = self.numbered(short).groupBy("__slot", *CUBE_KEYS, word).agg(
            F.bit_or(bit).alias(BITS),
            F.count(F.lit(1)).alias("vuelos"),
            F.sum("precio_usd").cast("decimal(38,2)").alias("usd"),
            F.sum(F.when(open_, F.col("precio_usd"))).cast("decimal(38,2)").alias("usd_operativo"),
            F.count_if(open_).alias("operativos"),
            F.sum("equipaje").alias("equipaje"),
            F.count_if(st == FL.CANCELLED).alias("cancelados"),
            F.count_if(operated).alias("operados"),
            F.count_if(operated & (F.col("retraso_minutos") > 0)).alias("retrasados"),
            F.sum(F.when(operated, F.col("retraso_minutos"))).alias("retraso"),
        )
        cells = cells.drop("__slot").withColumn("id_aerolinea", F.lower(F.hex("id_aerolinea")))
        return self.store.frame(self.store.full("cubo_vuelos", cells, [MONTH]))

    def measures(self, cells: DataFrame, by: list[str]) -> DataFrame:
        """J29-J40 and J43 of any grouping of cells: words merge by their number, then counts add up over the words.

        Only words travel by their numbers; the additive measures are added up by group alone.
        """
        words = cells.groupBy(*by, BUCKET).agg(F.bit_count(F.bit_or(BITS)).alias("distintos")).groupBy(*by).agg(F.sum("distintos").alias("distintos"))
        sums = cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ADDITIVE])
        g = sums.unionByName(words, allowMissingColumns=True).groupBy(*by).agg(
            F.coalesce(F.sum("vuelos"), F.lit(0)).cast("bigint").alias("total_vuelos"),
            F.sum("usd").cast("decimal(38,2)").alias("ingresos_totales_usd"),
            F.sum("usd_operativo").cast("decimal(38,2)").alias("ingresos_operativos_usd"),
            F.coalesce(F.sum("operativos"), F.lit(0)).cast("bigint").alias("vuelos_operativos"),
            F.coalesce(F.sum("distintos"), F.lit(0)).cast("bigint").alias("pasajeros_distintos"),
            F.sum("equipaje").alias("__eq"),
            F.coalesce(F.sum("cancelados"), F.lit(0)).cast("bigint").alias("vuelos_cancelados"),
            F.coalesce(F.sum("operados"), F.lit(0)).cast("bigint").alias("vuelos_operados"),
            F.coalesce(F.sum("retrasados"), F.lit(0)).cast("bigint").alias("vuelos_retrasados"),
            F.sum("retraso").alias("__ret"),
        )
        return FL.finished_measures(g, by)

    # ------------------------------------------------------------------- slicers
    def sliced(self, rows: DataFrame, s: Slicers) -> DataFrame:
        """Rows of the fact or the cube that the slicers leave; a period prunes the months' partitions when the query runs."""
        if s.anio is not None:
            keep = self.months.where(F.col("anio") == s.anio).select(MONTH)
            rows = rows.join(F.broadcast(keep), MONTH, "left_semi")
        if s.estado is not None:
            rows = rows.where(F.col("estado_vuelo") == s.estado)
        for value, dim, key, name in [(s.aerolinea, self.f.dim_aerolinea, "id_aerolinea", "nombre_aerolinea"), (s.clase, self.f.dim_clase_scd2, "id_clase_sk", "descripcion_clase")]:
            if value is not None:
                rows = rows.join(broadcast_bounded(dim.where(F.col(name) == value).select(key), SMALL_DIM_ROWS), key, "left_semi")
        return rows

    @cached_property
    def airline_names(self) -> DataFrame:
        return broadcast_bounded(self.f.dim_aerolinea.select("id_aerolinea", "nombre_aerolinea"))

    def revenue_trend(self, s: Slicers) -> DataFrame:
        m = self.measures(self.sliced(self.cells, s), [MONTH])
        return m.select(F.floor(F.col(MONTH) / 100).cast("int").alias("anio"), (F.col(MONTH) % 100).cast("int").alias("mes"), "ingresos_operativos_usd", "ticket_promedio_usd", "pasajeros_distintos")

    def top_airlines(self, s: Slicers, k: int = 10) -> DataFrame:
        m = self.measures(self.sliced(self.cells, s).join(self.airline_names, "id_aerolinea"), ["nombre_aerolinea"])
        return m.select("nombre_aerolinea", "ingresos_operativos_usd", "pasajeros_distintos").orderBy(F.col("ingresos_operativos_usd").desc(), "nombre_aerolinea").limit(k)

    def delay_by_origin(self, s: Slicers) -> DataFrame:
        h = self.sliced(self.fact, s).where(F.col("estado_vuelo").isin(*FL.OPERATED))
        g = h.groupBy("id_aeropuerto_origen").agg(F.sum("retraso_minutos").alias("s"), F.count(F.lit(1)).alias("vuelos_operados"))
        a = self.f.dim_aeropuerto.withColumnRenamed("id_aeropuerto", "id_aeropuerto_origen")
        return g.join(a, "id_aeropuerto_origen").select(F.col("codigo_iata").alias("aeropuerto_origen"), "vuelos_operados", X.safe_div("s", "vuelos_operados", 2).alias("retraso_promedio_min"))

    def top_destinations(self, s: Slicers, k: int = 5) -> DataFrame:
        g = self.sliced(self.fact, s).groupBy("id_aeropuerto_destino").agg(F.count(F.lit(1)).alias("total_vuelos"))
        a = self.f.dim_aeropuerto.withColumnRenamed("id_aeropuerto", "id_aeropuerto_destino")
        return g.join(a, "id_aeropuerto_destino").select(F.col("codigo_iata").alias("aeropuerto_destino"), "total_vuelos").orderBy(F.col("total_vuelos").desc(), "aeropuerto_destino").limit(k)

    def gender_share(self, s: Slicers) -> DataFrame:
        per = self.sliced(self.fact, s).groupBy("id_pasajero").agg(F.count(F.lit(1)).alias("n"))
        by = per.join(self.f.dim_pasajero.select("id_pasajero", "genero"), "id_pasajero").groupBy("genero").agg(F.sum("n").alias("vuelos"))
        return by.select("genero", "vuelos", X.pct(F.col("vuelos"), by.agg(F.sum("vuelos")).scalar()).alias("porcentaje"))

    def channel_payment(self, s: Slicers) -> DataFrame:
        h = self.sliced(self.fact, s)
        return h.groupBy("canal_venta").pivot("metodo_pago", self.payments()).agg(F.count(F.lit(1))).fillna(0)

    def payments(self) -> list[str]:
        """The methods of payment, which are columns of the matrix; more than 50 are no matrix."""
        found = [r[0] for r in self.fact.select("metodo_pago").distinct().orderBy("metodo_pago").limit(51).collect()]
        if len(found) > 50:
            raise ValueError("more than 50 methods of payment")
        return found


# ----------------------------------------------------------------------- queries
# Fixed slicer positions of the registered pages.
YEAR, STATUS = 1996, "ON_TIME"


def _airline(c: Cube) -> str:
    """The page's airline: the first by name."""
    return c.f.dim_aerolinea.agg(F.min("nombre_aerolinea")).first()[0]


def _class(c: Cube) -> str:
    return c.f.dim_clase_scd2.agg(F.min("descripcion_clase")).first()[0]


def j29_cube_total(c: Cube) -> DataFrame:
    return c.measures(c.cells, [])


def j29_cube_by_airline(c: Cube) -> DataFrame:
    return c.measures(c.cells.join(c.airline_names, "id_aerolinea", "left"), ["nombre_aerolinea"])


def j29_cube_by_class_status(c: Cube) -> DataFrame:
    cls = c.f.dim_clase_scd2.select("id_clase_sk", "descripcion_clase")
    return c.measures(c.cells.join(broadcast_bounded(cls, SMALL_DIM_ROWS), "id_clase_sk", "left"), ["descripcion_clase", "estado_vuelo"])


def j34_passengers_by_year(c: Cube) -> DataFrame:
    """Distinct passengers of each year, merged from the months' bitmaps."""
    return c.measures(c.cells.join(F.broadcast(c.months), MONTH), ["anio"]).select("anio", "total_vuelos", "pasajeros_distintos")


def j45_sliced_trend(c: Cube) -> DataFrame:
    return c.revenue_trend(Slicers(anio=YEAR, clase=_class(c)))


def j45_sliced_top_airlines(c: Cube) -> DataFrame:
    return c.top_airlines(Slicers(anio=YEAR, estado=STATUS))


def j45_sliced_delay_by_origin(c: Cube) -> DataFrame:
    return c.delay_by_origin(Slicers(aerolinea=_airline(c), anio=YEAR))


def j45_sliced_top_destinations(c: Cube) -> DataFrame:
    return c.top_destinations(Slicers(anio=YEAR, estado=STATUS, clase=_class(c)))


def j45_sliced_gender_share(c: Cube) -> DataFrame:
    return c.gender_share(Slicers(aerolinea=_airline(c), estado=STATUS))


def j45_sliced_channel_payment(c: Cube) -> DataFrame:
    m = c.channel_payment(Slicers(anio=YEAR))
    pays = [p for p in m.columns if p != "canal_venta"]
    long = F.explode(F.array(*[F.struct(F.lit(p).alias("metodo_pago"), F.col(f"`{p}`").alias("vuelos")) for p in pays]))
    return m.select("canal_venta", long.alias("x")).select("canal_venta", "x.metodo_pago", "x.vuelos")


def cube_of(w: Warehouse) -> Cube:
    c = getattr(w, "_cube", None)
    if c is None:
        c = w._cube = Cube(FL.flights_of(w))
    return c


def queries() -> dict:
    fns = [j29_cube_total, j29_cube_by_airline, j29_cube_by_class_status, j34_passengers_by_year, j45_sliced_trend, j45_sliced_top_airlines, j45_sliced_delay_by_origin,
           j45_sliced_top_destinations, j45_sliced_gender_share, j45_sliced_channel_payment]
    return {f.__name__: f for f in fns}
