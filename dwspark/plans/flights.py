"""Flight star schema (H16-H19), its queries (J14-J20) and BI measures.

Cleaning is column expressions over the raw records (no per-row Python);
dimensions are distinct / keep-first projections of the cleaned records with
md5 natural-key surrogates, so the fact computes its keys instead of looking
them up; the class dimension is SCD type 2 with the average USD price as the
tracked attribute. Measures accept any grouping columns.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.functions import clean as C
from dwspark.functions import exprs as X
from dwspark.functions.keys import sk, sk_date, sk_unknown
from dwspark.operators.joins import broadcast_bounded
from dwspark.operators.scd import CURRENT, END, START, scd2_history
from dwspark.operators.windows import dedup_first, period_shift
from dwspark.plans.warehouse import SMALL_DIM_ROWS, Warehouse
from dwspark.session import scratch_path

# Fixed values of the flight model.
CANCELLED = "CANCELLED"
OPERATED = ["ON_TIME", "DELAYED"]
NO_DATA = "SIN_DATO"
MONTH = "mes_particion"
PUNCTUALITY_GOAL = 0.85
PUNCTUALITY_RISK = 0.70
LIGHT_OK, LIGHT_RISK, LIGHT_BAD = "Cumple meta", "En riesgo", "Bajo desempeño"
# SCD2 loads of the class dimension: (as-of date, flights departing up to that date; None: all flights)
CLASS_LOADS = [("1998-12-31", "1998-12-31"), ("2001-12-31", None)]
TEXT_LIMITS = {"cod_aerolinea": 50, "nom_aerolinea": 100, "origen": 50, "destino": 50, "num_vuelo": 50, "estado": 50,
               "clase": 50, "canal": 50, "metodo_pago": 50, "pais": 50}


class Flights:
    def __init__(self, w: Warehouse):
        self.w = w
        self.spark = w.spark

    def _written(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """``df``; of a shared warehouse written once."""
        store = self.w.store
        return df if store is None else store.frame(store.full(name, df, partition_by))

    # ---------------------------------------------------------------- cleaning
    @cached_property
    def clean_by_month(self) -> DataFrame:
        """``clean`` and the month of departure.

        Of a shared warehouse it is written once, by month: the fact is a
        projection of it, and no dimension joins the sources again.
        """
        month = F.floor(F.coalesce(sk_date(F.to_date("salida_dt")), F.lit(-1)) / 100).cast("int")
        return self._written("vuelos_limpios", self._clean().withColumn(MONTH, month), [MONTH])

    @cached_property
    def clean(self) -> DataFrame:
        return self.clean_by_month.drop(MONTH)

    def _clean(self) -> DataFrame:
        """Typed, standardised flight records."""
        r = self.w.fx.vuelo()
        r = r.withColumns({c: F.col(c).cast("string") for c in ("cod_aerolinea", "origen", "destino", "duracion", "retraso", "equipaje")})
        out = r.select(
            "id_vuelo",
            *[C.truncate(c, n).alias(c) for c, n in TEXT_LIMITS.items() if c not in ("pais", "canal", "metodo_pago")],
            C.map_gender4("genero").alias("genero"),
            C.comma_decimal("precio_orig", "decimal(14,2)").alias("precio_orig"),
            C.to_number(F.col("precio_usd").cast("string"), "decimal(14,2)").alias("precio_usd"),
            C.parse_dates("salida", C.FLIGHT_DATE_PATTERNS).alias("salida_dt"),
            C.parse_dates("fecha_compra", C.FLIGHT_DATE_PATTERNS).alias("compra_dt"),
            C.int_or_zero("duracion").alias("duracion"),
            C.int_or_zero("retraso").alias("retraso"),
            C.int_or_zero("edad").alias("edad"),
            C.int_or_zero("equipaje").alias("equipaje"),
            C.default_text(C.truncate("pais", 50), NO_DATA).alias("pais"),
            C.default_text(C.truncate("canal", 50), NO_DATA).alias("canal"),
            C.default_text(C.truncate("metodo_pago", 50), NO_DATA).alias("metodo_pago"),
            F.col("uuid_pasajero").cast("string").alias("uuid_pasajero"),
        )
        return out

    # -------------------------------------------------------------- dimensions
    @cached_property
    def dim_tiempo(self) -> DataFrame:
        """Union of departure and purchase days."""
        c = self.clean
        days = c.select(F.to_date("salida_dt").alias("fecha")).union(c.select(F.to_date("compra_dt").alias("fecha")))
        days = days.filter(F.col("fecha").isNotNull()).distinct()
        return days.select(
            sk_date("fecha").alias("id_tiempo"), "fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
            X.month_name_en("fecha").alias("nombre_mes"), F.dayofmonth("fecha").alias("dia"),
            X.iso_weekday("fecha").alias("dia_semana"), X.day_name_en("fecha").alias("nombre_dia_semana"),
            F.quarter("fecha").alias("trimestre"),
        )

    @cached_property
    def dim_aerolinea(self) -> DataFrame:
        """First (code, name) per airline code (A20 insert-if-missing on an empty table)."""
        a = dedup_first(self.clean.select("cod_aerolinea", "nom_aerolinea", "salida_dt", "id_vuelo"),
                        ["cod_aerolinea"], ["salida_dt", "id_vuelo"])
        return self._written("dim_aerolinea", a.select(sk("cod_aerolinea").alias("id_aerolinea"), F.col("cod_aerolinea").alias("codigo_iata"),
                                                       F.col("nom_aerolinea").alias("nombre_aerolinea")))

    @cached_property
    def dim_aeropuerto(self) -> DataFrame:
        """Origins and destinations, one row per code."""
        c = self.clean
        codes = c.select(F.col("origen").alias("codigo_iata")).union(c.select(F.col("destino").alias("codigo_iata"))).distinct()
        return codes.select(sk("codigo_iata").alias("id_aeropuerto"), "codigo_iata",
                            F.concat(F.lit("Aeropuerto "), F.col("codigo_iata")).alias("descripcion"))

    @cached_property
    def dim_pasajero(self) -> DataFrame:
        """First record per passenger (F05 keep-first)."""
        p = dedup_first(self.clean.select("uuid_pasajero", "genero", "edad", "pais", "salida_dt", "id_vuelo"),
                        ["uuid_pasajero"], ["salida_dt", "id_vuelo"])
        return p.select(sk("uuid_pasajero").alias("id_pasajero"), "uuid_pasajero", "genero", "edad",
                        F.col("pais").alias("pais_origen"))

    @cached_property
    def _class_prices(self) -> DataFrame:
        """Per class, price sum and count up to each load date: one aggregate pass, written once, so that the history built on it never runs the flights again."""
        c = self.clean
        d = F.to_date("salida_dt")
        aggs = []
        for i, (_, upto) in enumerate(CLASS_LOADS):
            inside = F.lit(True) if upto is None else d <= F.lit(upto).cast("date")
            aggs += [F.sum(F.when(inside, F.col("precio_usd"))).alias(f"__s{i}"),
                     F.count(F.when(inside, F.col("precio_usd"))).alias(f"__n{i}"),
                     F.count_if(inside).alias(f"__r{i}")]
        prices = c.groupBy("clase").agg(*aggs)
        path = scratch_path(self.spark, "class-prices")
        prices.write.parquet(path)
        return self.spark.read.schema(prices.schema).parquet(path)

    def class_snapshot(self, upto: str | None) -> DataFrame:
        """Class attributes as of a load date: description and average USD price."""
        i = [u for _, u in CLASS_LOADS].index(upto)
        g = self._class_prices.filter(F.col(f"__r{i}") > 0)
        return g.select(F.col("clase").alias("id_clase_natural"),
                        F.concat(F.lit("Clase "), C.title_case("clase")).alias("descripcion_clase"),
                        X.safe_div(f"__s{i}", f"__n{i}", 2).alias("precio_promedio_base"))

    @cached_property
    def dim_clase_scd2(self) -> DataFrame:
        """SCD2 history after the configured loads, all in one pass."""
        loads = [self.class_snapshot(upto).withColumn("as_of", F.lit(as_of).cast("date")) for as_of, upto in CLASS_LOADS]
        return scd2_history(reduce(DataFrame.unionByName, loads), "id_clase_natural", ["precio_promedio_base"], sk_col="id_clase_sk")

    # -------------------------------------------------------------------- fact
    @cached_property
    def hechos_vuelos(self) -> DataFrame:
        return self.fact_by_month.drop(MONTH)

    @cached_property
    def fact_by_month(self) -> DataFrame:
        """Flight fact (H19) and its month: keys computed from natural keys; missing -> unknown; price NULL -> 0."""
        c = self.clean_by_month
        # one row a class, counted before it is broadcast: the flights are not shuffled by a few hot classes
        cls = self.dim_clase_scd2.filter(F.col(CURRENT)).select(F.col("id_clase_natural").alias("clase"), "id_clase_sk")
        j = c.join(broadcast_bounded(cls, SMALL_DIM_ROWS), "clase", "left")

        def key(col: str) -> Column:
            return F.when(F.col(col).isNull(), sk_unknown()).otherwise(sk(col))

        return j.select(
            "id_vuelo",
            F.coalesce(sk_date(F.to_date("salida_dt")), F.lit(-1)).alias("id_tiempo"),
            key("cod_aerolinea").alias("id_aerolinea"),
            key("origen").alias("id_aeropuerto_origen"),
            key("destino").alias("id_aeropuerto_destino"),
            key("uuid_pasajero").alias("id_pasajero"),
            F.coalesce("id_clase_sk", sk_unknown()).alias("id_clase_sk"),
            F.col("num_vuelo").alias("numero_vuelo"),
            F.col("estado").alias("estado_vuelo"),
            F.col("duracion").alias("duracion_minutos"),
            F.col("retraso").alias("retraso_minutos"),
            F.col("canal").alias("canal_venta"),
            "metodo_pago",
            F.coalesce("precio_orig", F.lit(0).cast("decimal(14,2)")).alias("precio_original"),
            F.coalesce("precio_usd", F.lit(0).cast("decimal(14,2)")).alias("precio_usd"),
            "equipaje",
            MONTH,
        )


def flights_of(w: Warehouse) -> Flights:
    """One shared ``Flights`` per warehouse."""
    f = getattr(w, "_flights", None)
    if f is None:
        f = w._flights = Flights(w)
    return f


# ===================================================================== queries
def j14_load_count(f: Flights) -> DataFrame:
    raw = f.w.fx.vuelo().agg(F.lit("Total Registros CSV").alias("concepto"), F.count(F.lit(1)).alias("cantidad"))
    fact = f.hechos_vuelos.agg(F.lit("Total Hechos Cargados").alias("concepto"), F.count(F.lit(1)).alias("cantidad"))
    return raw.unionByName(fact)


def j15_top_destinations(f: Flights, k: int = 5) -> DataFrame:
    g = f.hechos_vuelos.groupBy("id_aeropuerto_destino").agg(F.count(F.lit(1)).alias("total_vuelos"))
    a = f.dim_aeropuerto.withColumnRenamed("id_aeropuerto", "id_aeropuerto_destino")
    return g.join(a, "id_aeropuerto_destino").select(
        F.col("codigo_iata").alias("aeropuerto_destino"), "descripcion", "total_vuelos"
    ).orderBy(F.col("total_vuelos").desc(), "aeropuerto_destino").limit(k)


def j16_gender_share(f: Flights) -> DataFrame:
    g = f.hechos_vuelos.groupBy("id_pasajero").agg(F.count(F.lit(1)).alias("n"))
    by = g.join(f.dim_pasajero.select("id_pasajero", "genero"), "id_pasajero").groupBy("genero").agg(
        F.sum("n").alias("cantidad_pasajeros"))
    total = f.hechos_vuelos.agg(F.count(F.lit(1))).scalar()
    return by.select("genero", F.col("cantidad_pasajeros").cast("bigint"),
                     X.pct(F.col("cantidad_pasajeros"), total).alias("porcentaje"))


def j17_revenue_airline_month(f: Flights) -> DataFrame:
    h = f.hechos_vuelos.filter(F.col("estado_vuelo") != CANCELLED)
    g = h.groupBy("id_aerolinea", "id_tiempo").agg(F.sum("precio_usd").alias("s"), F.count(F.lit(1)).alias("n"))
    t = f.dim_tiempo.select("id_tiempo", "nombre_mes", "anio", "mes")
    a = f.dim_aerolinea.select("id_aerolinea", "nombre_aerolinea")
    return g.join(t, "id_tiempo").join(a, "id_aerolinea").groupBy("nombre_aerolinea", "nombre_mes", "anio", "mes").agg(
        X.sum_dec("s").alias("ingresos_totales_usd"), F.sum("n").cast("bigint").alias("boletos_vendidos"))


def j18_delay_by_origin(f: Flights) -> DataFrame:
    h = f.hechos_vuelos.filter(F.col("estado_vuelo").isin(*OPERATED))
    g = h.groupBy("id_aeropuerto_origen").agg(
        F.sum("retraso_minutos").alias("s"), F.count(F.lit(1)).alias("n"),
        F.max("retraso_minutos").alias("maximo_retraso_min"),
        F.count_if(F.col("retraso_minutos") > 0).alias("vuelos_retrasados"))
    a = f.dim_aeropuerto.withColumnRenamed("id_aeropuerto", "id_aeropuerto_origen")
    j = g.join(a, "id_aeropuerto_origen").groupBy("codigo_iata").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("maximo_retraso_min").alias("maximo_retraso_min"),
        F.sum("vuelos_retrasados").cast("bigint").alias("vuelos_retrasados"))
    return j.filter(F.col("s") > 0).select(
        F.col("codigo_iata").alias("aeropuerto_origen"), X.safe_div("s", "n", 4).alias("promedio_retraso_min"),
        "maximo_retraso_min", "vuelos_retrasados")


def j19_channel_payment(f: Flights) -> DataFrame:
    h = f.hechos_vuelos.filter(F.col("estado_vuelo") != CANCELLED)
    g = h.groupBy("canal_venta", "metodo_pago").agg(F.count(F.lit(1)).alias("transacciones"), F.sum("precio_usd").alias("s"))
    return g.select("canal_venta", "metodo_pago", "transacciones", X.safe_div("s", "transacciones", 2).alias("ticket_promedio_usd"))


def j20_scd2_history(f: Flights) -> DataFrame:
    d = f.dim_clase_scd2
    return d.select(
        "id_clase_sk", "id_clase_natural", "descripcion_clase", "precio_promedio_base", START, END,
        F.when(F.col(CURRENT), F.lit("Vigente")).otherwise(F.lit("Histórico")).alias("estado_registro"))


def h19_hechos_vuelos(f: Flights) -> DataFrame:
    return f.hechos_vuelos


def h18_dim_tiempo(f: Flights) -> DataFrame:
    return f.dim_tiempo


def h18_dim_aerolinea(f: Flights) -> DataFrame:
    return f.dim_aerolinea


def h18_dim_aeropuerto(f: Flights) -> DataFrame:
    return f.dim_aeropuerto


def h18_dim_pasajero(f: Flights) -> DataFrame:
    return f.dim_pasajero


def h17_class_snapshot(f: Flights) -> DataFrame:
    """Average USD price by class over all flights (the tracked SCD2 attribute)."""
    return f.class_snapshot(CLASS_LOADS[-1][1])


# -------------------------------------------------------------------- measures
def flight_measures(fact: DataFrame, by: list[str]) -> DataFrame:
    """J29-J40 and J43 over any grouping (``by=[]`` gives the grand total)."""
    st = F.col("estado_vuelo")
    not_cancelled = ~st.eqNullSafe(F.lit(CANCELLED))  # DAX <> keeps blank status
    operated = st.isin(*OPERATED)
    g = fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_vuelos"),
        X.sum_dec("precio_usd").alias("ingresos_totales_usd"),
        F.sum(F.when(not_cancelled, F.col("precio_usd"))).cast("decimal(38,2)").alias("ingresos_operativos_usd"),
        F.count_if(not_cancelled).alias("vuelos_operativos"),
        F.count_distinct("id_pasajero").alias("pasajeros_distintos"),
        F.sum("equipaje").alias("__eq"),
        F.count_if(st == CANCELLED).alias("vuelos_cancelados"),
        F.count_if(operated).alias("vuelos_operados"),
        F.count_if(operated & (F.col("retraso_minutos") > 0)).alias("vuelos_retrasados"),
        F.sum(F.when(operated, F.col("retraso_minutos"))).alias("__ret"),
    )
    return finished_measures(g, by)


def finished_measures(g: DataFrame, by: list[str]) -> DataFrame:
    """The measures' ratios and lights from their sums and counts."""
    punct = F.coalesce(F.lit(1.0) - F.col("vuelos_retrasados").cast("double") / F.nullif(F.col("vuelos_operados").cast("double"), F.lit(0.0)), F.lit(1.0))
    punct_dec = F.round(punct.cast("decimal(24,8)"), 4).cast("decimal(18,4)")
    return g.select(
        *by, "total_vuelos", "ingresos_totales_usd", "ingresos_operativos_usd", "vuelos_operativos",
        X.safe_div("ingresos_operativos_usd", "vuelos_operativos", 2).alias("ticket_promedio_usd"),
        "pasajeros_distintos",
        X.safe_div("__eq", "total_vuelos", 2).alias("equipaje_promedio"),
        "vuelos_cancelados",
        X.safe_div("vuelos_cancelados", "total_vuelos", 4).alias("pct_cancelacion"),
        "vuelos_operados", "vuelos_retrasados",
        punct_dec.alias("pct_puntualidad"),
        X.safe_div("__ret", "vuelos_operados", 2).alias("retraso_promedio_min"),
        F.when(punct_dec >= PUNCTUALITY_GOAL, F.lit(LIGHT_OK)).when(punct_dec >= PUNCTUALITY_RISK, F.lit(LIGHT_RISK))
        .otherwise(F.lit(LIGHT_BAD)).alias("semaforo_puntualidad"),
    )


def _fact_with(f: Flights, *dims: str) -> DataFrame:
    """The fact with the attributes of the requested dimensions.

    Calendar attributes are a pure function of the ``yyyyMMdd`` key, and the
    calendar holds every fact date by construction, so they are computed from
    the key instead of joining a dimension that is itself derived from the
    facts (which would cost another pass over them).
    """
    h = f.hechos_vuelos
    if "tiempo" in dims:
        d = F.to_date(F.col("id_tiempo").cast("string"), "yyyyMMdd")
        h = h.withColumns({"anio": F.year(d), "mes": F.month(d), "trimestre": F.quarter(d), "dia": F.dayofmonth(d)})
    if "aerolinea" in dims:
        h = h.join(f.dim_aerolinea, "id_aerolinea", "left")
    if "pasajero" in dims:
        h = h.join(f.dim_pasajero, "id_pasajero", "left")
    return h


def j29_measures_total(f: Flights) -> DataFrame:
    return flight_measures(f.hechos_vuelos, [])


def j29_measures_by_airline(f: Flights) -> DataFrame:
    return flight_measures(_fact_with(f, "aerolinea"), ["nombre_aerolinea"])


def j29_measures_by_class_status(f: Flights) -> DataFrame:
    """Measures sliced by two slicers at once (class x status)."""
    cls = f.dim_clase_scd2.select("id_clase_sk", "descripcion_clase")
    return flight_measures(f.hechos_vuelos.join(cls, "id_clase_sk", "left"), ["descripcion_clase", "estado_vuelo"])


def _monthly_operating_revenue(f: Flights) -> DataFrame:
    h = _fact_with(f, "tiempo").filter(~F.col("estado_vuelo").eqNullSafe(F.lit(CANCELLED)))
    return h.groupBy(F.make_date("anio", "mes", F.lit(1)).alias("mes_inicio")).agg(
        X.sum_dec("precio_usd").alias("ingresos_operativos_usd"))


def j41_revenue_mom(f: Flights) -> DataFrame:
    """Previous calendar month revenue and MoM growth; a missing month gives NULL."""
    m = period_shift(_monthly_operating_revenue(f), [], "mes_inicio", "ingresos_operativos_usd", 1, "ingresos_mes_anterior")
    return m.withColumn("pct_crecimiento_mom",
                        X.safe_div(F.col("ingresos_operativos_usd") - F.col("ingresos_mes_anterior"), "ingresos_mes_anterior", 4))


def j42_revenue_yoy(f: Flights) -> DataFrame:
    m = period_shift(_monthly_operating_revenue(f), [], "mes_inicio", "ingresos_operativos_usd", 12, "ingresos_anio_anterior")
    return m.withColumn("pct_crecimiento_yoy",
                        X.safe_div(F.col("ingresos_operativos_usd") - F.col("ingresos_anio_anterior"), "ingresos_anio_anterior", 4))


def j43_punctuality_light_by_month(f: Flights) -> DataFrame:
    m = flight_measures(_fact_with(f, "tiempo"), ["anio", "mes"])
    return m.select("anio", "mes", "vuelos_operados", "vuelos_retrasados", "pct_puntualidad", "semaforo_puntualidad")


def j44_time_drilldown(f: Flights) -> DataFrame:
    """Year > Quarter > Month > Day hierarchy with subtotal levels."""
    h = _fact_with(f, "tiempo").filter(~F.col("estado_vuelo").eqNullSafe(F.lit(CANCELLED)))
    daily = h.groupBy("anio", "trimestre", "mes", "dia").agg(F.sum("precio_usd").alias("s"), F.count(F.lit(1)).alias("n"))
    return daily.rollup("anio", "trimestre", "mes", "dia").agg(
        X.sum_dec("s").alias("ingresos_operativos_usd"), F.sum("n").cast("bigint").alias("vuelos_operativos"),
        F.grouping_id().cast("int").alias("nivel"))


def j44_passenger_drilldown(f: Flights) -> DataFrame:
    """Country > Gender hierarchy of flights; flights are counted by passenger, then by the lowest level, before the rollup."""
    per = f.hechos_vuelos.groupBy("id_pasajero").agg(F.count(F.lit(1)).alias("n"))
    lowest = per.join(f.dim_pasajero, "id_pasajero", "left").groupBy("pais_origen", "genero").agg(F.sum("n").alias("n"))
    return lowest.rollup("pais_origen", "genero").agg(F.sum("n").cast("bigint").alias("total_vuelos"), F.grouping_id().cast("int").alias("nivel"))


def j45_top_airlines(f: Flights, k: int = 10) -> DataFrame:
    m = flight_measures(_fact_with(f, "aerolinea"), ["nombre_aerolinea"]).select("nombre_aerolinea", "ingresos_operativos_usd")
    return m.orderBy(F.col("ingresos_operativos_usd").desc(), "nombre_aerolinea").limit(k)


def j45_revenue_trend(f: Flights) -> DataFrame:
    m = flight_measures(_fact_with(f, "tiempo"), ["anio", "trimestre", "mes"])
    return m.select("anio", "trimestre", "mes", "ingresos_operativos_usd", "ticket_promedio_usd")


def queries() -> dict:
    fns = [h17_class_snapshot, h18_dim_tiempo, h18_dim_aerolinea, h18_dim_aeropuerto, h18_dim_pasajero,
           h19_hechos_vuelos, j14_load_count, j15_top_destinations, j16_gender_share, j17_revenue_airline_month,
           j18_delay_by_origin, j19_channel_payment, j20_scd2_history, j29_measures_total, j29_measures_by_airline,
           j29_measures_by_class_status, j41_revenue_mom, j42_revenue_yoy, j43_punctuality_light_by_month,
           j44_time_drilldown, j44_passenger_drilldown, j45_top_airlines, j45_revenue_trend]
    return {fn.__name__: fn for fn in fns}
