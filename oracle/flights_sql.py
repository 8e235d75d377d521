"""Oracle SQL for the flight star schema and its measures."""

from __future__ import annotations

from oracle.ctes import with_ctes


def _md5key(c: str) -> str:
    return f"md5(concat_ws('-', coalesce(cast({c} as varchar), '<null>')))"


def _key(c: str) -> str:
    return f"case when {c} is null then md5('-1') else {_md5key(c)} end"


def _div(a: str, b: str, scale: int, factor: str = "") -> str:
    return (f"cast(round(cast(cast({a} as double) / nullif(cast({b} as double), 0){factor} as decimal(24,8)), {scale})"
            f" as decimal(18,{scale}))")


def _ts(c: str) -> str:
    s = f"nullif(trim({c}), '')"
    pats = ["%d/%m/%Y %H:%M", "%m-%d-%Y %I:%M %p", "%d-%m-%Y %H:%M", "%Y-%m-%d %H:%M"]
    return "coalesce(" + ", ".join(f"try_strptime({s}, '{p}')" for p in pats) + ")"


def _int0(c: str) -> str:
    return f"coalesce(try_cast(try_cast(cast({c} as varchar) as double) as int), 0)"


FLIGHT_CTES = [
    ("fx_vuelo", """
        select l.id_detalle as id_vuelo, l.id_proveedor as cod_aerolinea, s.s_name as nom_aerolinea,
               concat('VN', cast(cast(l.id_venta % 1000 as int) as varchar)) as num_vuelo,
               s.s_nationkey as origen, v.id_sucursal as destino,
               case cast(l.id_venta % 4 as int) when 0 then concat(strftime(v.fecha, '%d/%m/%Y'), ' 08:30')
                    when 1 then concat(strftime(v.fecha, '%m-%d-%Y'), ' 09:15 PM')
                    when 2 then concat(strftime(v.fecha, '%d-%m-%Y'), ' 14:05')
                    else concat(strftime(v.fecha, '%Y-%m-%d'), ' 23:59') end as salida,
               concat(strftime(v.fecha - cast(v.id_cliente % 30 as int), '%Y-%m-%d'), ' 10:00') as fecha_compra,
               cast(40 + cast(l.id_proveedor % 300 as int) as int) as duracion,
               case when cast(l.id_venta % 20 as int) = 0 then 'CANCELLED' when cast(l.id_venta % 20 as int) = 1 then 'DIVERTED'
                    when cast(l.id_venta % 20 as int) <= 6 then 'DELAYED' else 'ON_TIME' end as estado,
               cast(case when cast(l.id_venta % 20 as int) between 2 and 6 then 5 + cast(l.id_producto % 90 as int) else 0 end as int)
                   as retraso,
               p.categoria as clase, v.id_cliente as uuid_pasajero,
               case cast(v.id_cliente % 7 as int) when 0 then 'm' when 1 then ' M ' when 2 then 'Femenino' when 3 then 'F'
                    when 4 then 'x' when 5 then 'No Binario' else '' end as genero,
               cast(18 + cast(v.id_cliente % 60 as int) as varchar) as edad,
               concat('Pais ', cast(v.id_sucursal as varchar)) as pais,
               v.canal, v.metodo_pago, l.subtotal as precio_usd, replace(cast(l.subtotal as varchar), '.', ',') as precio_orig,
               cast(l.cantidad % 4 as int) as equipaje
        from fx_linea l join fx_venta v on l.id_venta = v.id_venta join supplier s on l.id_proveedor = s.s_suppkey
        join fx_producto p on l.id_producto = p.id_producto"""),
    ("fl_clean", f"""
        select id_vuelo,
               substring(cast(cod_aerolinea as varchar), 1, 50) as cod_aerolinea, substring(nom_aerolinea, 1, 100) as nom_aerolinea,
               substring(cast(origen as varchar), 1, 50) as origen, substring(cast(destino as varchar), 1, 50) as destino,
               substring(num_vuelo, 1, 50) as num_vuelo, substring(estado, 1, 50) as estado, substring(clase, 1, 50) as clase,
               case when lower(regexp_replace(regexp_replace(genero, '^\\s+', ''), '\\s+$', '')) in ('m', 'masculino') then 'Masculino'
                    when lower(regexp_replace(regexp_replace(genero, '^\\s+', ''), '\\s+$', '')) in ('f', 'femenino') then 'Femenino'
                    when lower(regexp_replace(regexp_replace(genero, '^\\s+', ''), '\\s+$', '')) in ('x', 'nobinario', 'no binario')
                        then 'No Binario'
                    else 'No Especificado' end as genero,
               try_cast(replace(cast(precio_orig as varchar), ',', '.') as decimal(14,2)) as precio_orig,
               try_cast(cast(precio_usd as varchar) as decimal(14,2)) as precio_usd,
               {_ts('salida')} as salida_dt, {_ts('fecha_compra')} as compra_dt,
               {_int0('duracion')} as duracion, {_int0('retraso')} as retraso, {_int0('edad')} as edad, {_int0('equipaje')} as equipaje,
               coalesce(nullif(substring(pais, 1, 50), ''), 'SIN_DATO') as pais,
               coalesce(nullif(substring(canal, 1, 50), ''), 'SIN_DATO') as canal,
               coalesce(nullif(substring(metodo_pago, 1, 50), ''), 'SIN_DATO') as metodo_pago,
               cast(uuid_pasajero as varchar) as uuid_pasajero
        from fx_vuelo"""),
    ("fl_dim_tiempo", """
        select cast(strftime(fecha, '%Y%m%d') as int) as id_tiempo, fecha, cast(year(fecha) as int) as anio,
               cast(month(fecha) as int) as mes, strftime(fecha, '%B') as nombre_mes, cast(day(fecha) as int) as dia,
               cast(isodow(fecha) as int) as dia_semana, strftime(fecha, '%A') as nombre_dia_semana,
               cast(quarter(fecha) as int) as trimestre
        from (select distinct fecha from (select cast(salida_dt as date) as fecha from fl_clean
                                          union all select cast(compra_dt as date) from fl_clean) where fecha is not null)"""),
    ("fl_dim_aerolinea", f"""
        select {_md5key('cod_aerolinea')} as id_aerolinea, cod_aerolinea as codigo_iata, nom_aerolinea as nombre_aerolinea
        from (select *, row_number() over (partition by cod_aerolinea order by salida_dt nulls first, id_vuelo nulls first) as rn
              from fl_clean) where rn = 1"""),
    ("fl_dim_aeropuerto", f"""
        select {_md5key('codigo_iata')} as id_aeropuerto, codigo_iata, concat('Aeropuerto ', codigo_iata) as descripcion
        from (select origen as codigo_iata from fl_clean union select destino from fl_clean)"""),
    ("fl_dim_pasajero", f"""
        select {_md5key('uuid_pasajero')} as id_pasajero, uuid_pasajero, genero, edad, pais as pais_origen
        from (select *, row_number() over (partition by uuid_pasajero order by salida_dt nulls first, id_vuelo nulls first) as rn
              from fl_clean) where rn = 1"""),
    ("fl_snap1", f"""
        select clase as id_clase_natural, concat('Clase ', upper(substring(clase, 1, 1)), lower(substring(clase, 2))) as descripcion_clase,
               {_div('sum(precio_usd)', 'count(precio_usd)', 2)} as precio_promedio_base
        from fl_clean where cast(salida_dt as date) <= date '1998-12-31' group by clase"""),
    ("fl_snap2", f"""
        select clase as id_clase_natural, concat('Clase ', upper(substring(clase, 1, 1)), lower(substring(clase, 2))) as descripcion_clase,
               {_div('sum(precio_usd)', 'count(precio_usd)', 2)} as precio_promedio_base
        from fl_clean group by clase"""),
    ("fl_load1", """
        select md5(concat_ws('-', id_clase_natural, '1998-12-31')) as id_clase_sk, id_clase_natural, descripcion_clase,
               precio_promedio_base, date '1998-12-31' as fecha_inicio_vigencia, cast(null as date) as fecha_fin_vigencia,
               true as es_actual
        from fl_snap1"""),
    ("fl_changed", """
        select s.* from fl_snap2 s
        where not exists (select 1 from fl_load1 c where c.es_actual and c.id_clase_natural = s.id_clase_natural
                          and c.precio_promedio_base is not distinct from s.precio_promedio_base)"""),
    ("fl_dim_clase", """
        select id_clase_sk, id_clase_natural, descripcion_clase, precio_promedio_base, fecha_inicio_vigencia,
               case when id_clase_natural in (select id_clase_natural from fl_changed) then date '2001-12-31' end as fecha_fin_vigencia,
               id_clase_natural not in (select id_clase_natural from fl_changed) as es_actual
        from fl_load1
        union all
        select md5(concat_ws('-', id_clase_natural, '2001-12-31')), id_clase_natural, descripcion_clase, precio_promedio_base,
               date '2001-12-31', cast(null as date), true
        from fl_changed"""),
    ("fl_hechos", f"""
        select c.id_vuelo, coalesce(cast(strftime(cast(c.salida_dt as date), '%Y%m%d') as int), -1) as id_tiempo,
               {_key('c.cod_aerolinea')} as id_aerolinea, {_key('c.origen')} as id_aeropuerto_origen,
               {_key('c.destino')} as id_aeropuerto_destino, {_key('c.uuid_pasajero')} as id_pasajero,
               coalesce(k.id_clase_sk, md5('-1')) as id_clase_sk, c.num_vuelo as numero_vuelo, c.estado as estado_vuelo,
               c.duracion as duracion_minutos, c.retraso as retraso_minutos, c.canal as canal_venta, c.metodo_pago,
               cast(coalesce(c.precio_orig, 0) as decimal(14,2)) as precio_original,
               cast(coalesce(c.precio_usd, 0) as decimal(14,2)) as precio_usd, c.equipaje
        from fl_clean c left join (select id_clase_natural, id_clase_sk from fl_dim_clase where es_actual) k
          on k.id_clase_natural = c.clase"""),
]


def measures_sql(src: str, by: list[str]) -> str:
    """J29-J40 + J43 over ``src`` grouped by ``by``."""
    nc = "not (estado_vuelo is not distinct from 'CANCELLED')"
    op = "estado_vuelo in ('ON_TIME', 'DELAYED')"
    g = ", ".join(by)
    sel = (g + ", ") if by else ""
    grp = f"group by {g}" if by else ""
    punct = ("cast(round(cast(coalesce(1.0 - cast(vuelos_retrasados as double) / nullif(cast(vuelos_operados as double), 0), 1.0)"
             " as decimal(24,8)), 4) as decimal(18,4))")
    return f"""
        select {sel}total_vuelos, ingresos_totales_usd, ingresos_operativos_usd, vuelos_operativos,
               {_div('ingresos_operativos_usd', 'vuelos_operativos', 2)} as ticket_promedio_usd, pasajeros_distintos,
               {_div('eq', 'total_vuelos', 2)} as equipaje_promedio, vuelos_cancelados,
               {_div('vuelos_cancelados', 'total_vuelos', 4)} as pct_cancelacion, vuelos_operados, vuelos_retrasados,
               {punct} as pct_puntualidad, {_div('ret', 'vuelos_operados', 2)} as retraso_promedio_min,
               case when {punct} >= 0.85 then 'Cumple meta' when {punct} >= 0.70 then 'En riesgo' else 'Bajo desempeño' end
                   as semaforo_puntualidad
        from (select {sel}count(*) as total_vuelos, cast(sum(precio_usd) as decimal(38,2)) as ingresos_totales_usd,
                     cast(sum(precio_usd) filter (where {nc}) as decimal(38,2)) as ingresos_operativos_usd,
                     count(*) filter (where {nc}) as vuelos_operativos, count(distinct id_pasajero) as pasajeros_distintos,
                     sum(equipaje) as eq, count(*) filter (where estado_vuelo = 'CANCELLED') as vuelos_cancelados,
                     count(*) filter (where {op}) as vuelos_operados,
                     count(*) filter (where {op} and retraso_minutos > 0) as vuelos_retrasados,
                     sum(retraso_minutos) filter (where {op}) as ret
              from {src} {grp}) m"""


_F_T = "(select h.*, t.anio, t.mes, t.trimestre, t.dia from fl_hechos h left join fl_dim_tiempo t on t.id_tiempo = h.id_tiempo)"
_F_A = "(select h.*, a.nombre_aerolinea from fl_hechos h left join fl_dim_aerolinea a on a.id_aerolinea = h.id_aerolinea)"
_F_P = "(select h.*, p.genero, p.pais_origen from fl_hechos h left join fl_dim_pasajero p on p.id_pasajero = h.id_pasajero)"
_F_C = "(select h.*, c.descripcion_clase from fl_hechos h left join fl_dim_clase c on c.id_clase_sk = h.id_clase_sk)"
_MONTHLY = f"""(select make_date(anio, mes, 1) as mes_inicio, cast(sum(precio_usd) as decimal(38,2)) as ingresos_operativos_usd
               from {_F_T} where not (estado_vuelo is not distinct from 'CANCELLED') group by 1)"""

FLIGHT_QUERIES = {
    "h17_class_snapshot": "select * from fl_snap2",
    "h18_dim_tiempo": "select * from fl_dim_tiempo",
    "h18_dim_aerolinea": "select * from fl_dim_aerolinea",
    "h18_dim_aeropuerto": "select * from fl_dim_aeropuerto",
    "h18_dim_pasajero": "select * from fl_dim_pasajero",
    "h19_hechos_vuelos": "select * from fl_hechos",
    "j14_load_count": """
        select 'Total Registros CSV' as concepto, count(*) as cantidad from fx_vuelo
        union all select 'Total Hechos Cargados', count(*) from fl_hechos""",
    "j15_top_destinations": """
        select a.codigo_iata as aeropuerto_destino, a.descripcion, count(*) as total_vuelos
        from fl_hechos h join fl_dim_aeropuerto a on h.id_aeropuerto_destino = a.id_aeropuerto
        group by a.codigo_iata, a.descripcion order by total_vuelos desc, aeropuerto_destino limit 5""",
    "j16_gender_share": f"""
        select p.genero, count(*) as cantidad_pasajeros, {_div('count(*)', '(select count(*) from fl_hechos)', 2, ' * 100')} as porcentaje
        from fl_hechos h join fl_dim_pasajero p on h.id_pasajero = p.id_pasajero group by p.genero""",
    "j17_revenue_airline_month": """
        select a.nombre_aerolinea, t.nombre_mes, t.anio, t.mes, cast(sum(h.precio_usd) as decimal(38,2)) as ingresos_totales_usd,
               count(*) as boletos_vendidos
        from fl_hechos h join fl_dim_aerolinea a on h.id_aerolinea = a.id_aerolinea join fl_dim_tiempo t on h.id_tiempo = t.id_tiempo
        where h.estado_vuelo <> 'CANCELLED' group by a.nombre_aerolinea, t.nombre_mes, t.anio, t.mes""",
    "j18_delay_by_origin": f"""
        select a.codigo_iata as aeropuerto_origen, {_div('sum(h.retraso_minutos)', 'count(*)', 4)} as promedio_retraso_min,
               max(h.retraso_minutos) as maximo_retraso_min, cast(sum(case when h.retraso_minutos > 0 then 1 else 0 end) as bigint)
               as vuelos_retrasados
        from fl_hechos h join fl_dim_aeropuerto a on h.id_aeropuerto_origen = a.id_aeropuerto
        where h.estado_vuelo in ('DELAYED', 'ON_TIME') group by a.codigo_iata having sum(h.retraso_minutos) > 0""",
    "j19_channel_payment": f"""
        select canal_venta, metodo_pago, count(*) as transacciones, {_div('sum(precio_usd)', 'count(*)', 2)} as ticket_promedio_usd
        from fl_hechos where estado_vuelo <> 'CANCELLED' group by canal_venta, metodo_pago""",
    "j20_scd2_history": """
        select id_clase_sk, id_clase_natural, descripcion_clase, precio_promedio_base, fecha_inicio_vigencia, fecha_fin_vigencia,
               case when es_actual then 'Vigente' else 'Histórico' end as estado_registro
        from fl_dim_clase""",
    "j29_measures_total": measures_sql("fl_hechos", []),
    "j29_measures_by_airline": measures_sql(_F_A, ["nombre_aerolinea"]),
    "j29_measures_by_class_status": measures_sql(_F_C, ["descripcion_clase", "estado_vuelo"]),
    "j41_revenue_mom": f"""
        select m.mes_inicio, m.ingresos_operativos_usd, p.ingresos_operativos_usd as ingresos_mes_anterior,
               {_div('m.ingresos_operativos_usd - p.ingresos_operativos_usd', 'p.ingresos_operativos_usd', 4)} as pct_crecimiento_mom
        from {_MONTHLY} m left join {_MONTHLY} p on p.mes_inicio = cast(m.mes_inicio - interval 1 month as date)""",
    "j42_revenue_yoy": f"""
        select m.mes_inicio, m.ingresos_operativos_usd, p.ingresos_operativos_usd as ingresos_anio_anterior,
               {_div('m.ingresos_operativos_usd - p.ingresos_operativos_usd', 'p.ingresos_operativos_usd', 4)} as pct_crecimiento_yoy
        from {_MONTHLY} m left join {_MONTHLY} p on p.mes_inicio = cast(m.mes_inicio - interval 12 month as date)""",
    "j43_punctuality_light_by_month": f"""
        select anio, mes, vuelos_operados, vuelos_retrasados, pct_puntualidad, semaforo_puntualidad
        from ({measures_sql(_F_T, ['anio', 'mes'])})""",
    "j44_time_drilldown": """
        select anio, trimestre, mes, dia, cast(sum(precio_usd) as decimal(38,2)) as ingresos_operativos_usd,
               count(*) as vuelos_operativos, cast(grouping_id(anio, trimestre, mes, dia) as int) as nivel
        from """ + _F_T + """ where not (estado_vuelo is not distinct from 'CANCELLED')
        group by rollup (anio, trimestre, mes, dia)""",
    "j44_passenger_drilldown": f"""
        select pais_origen, genero, count(*) as total_vuelos, cast(grouping_id(pais_origen, genero) as int) as nivel
        from {_F_P} group by rollup (pais_origen, genero)""",
    "j45_top_airlines": f"""
        select nombre_aerolinea, ingresos_operativos_usd from ({measures_sql(_F_A, ['nombre_aerolinea'])})
        order by ingresos_operativos_usd desc, nombre_aerolinea limit 10""",
    "j45_revenue_trend": f"""
        select anio, trimestre, mes, ingresos_operativos_usd, ticket_promedio_usd
        from ({measures_sql(_F_T, ['anio', 'trimestre', 'mes'])})""",
}

# Report pages behind slicers: the first airline and class by name, one year, one status.
_AIR = "id_aerolinea in (select id_aerolinea from fl_dim_aerolinea where nombre_aerolinea = (select min(nombre_aerolinea) from fl_dim_aerolinea))"
_CLS = "id_clase_sk in (select id_clase_sk from fl_dim_clase where descripcion_clase = (select min(descripcion_clase) from fl_dim_clase))"
_YEAR = "id_tiempo between 19960000 and 19969999"
_DONE = "estado_vuelo = 'ON_TIME'"
_TREND = f"(select *, 1996 as anio, cast(id_tiempo // 100 % 100 as int) as mes from fl_hechos where {_YEAR} and {_CLS})"
FLIGHT_QUERIES |= {
    "j29_cube_total": FLIGHT_QUERIES["j29_measures_total"],
    "j29_cube_by_airline": FLIGHT_QUERIES["j29_measures_by_airline"],
    "j29_cube_by_class_status": FLIGHT_QUERIES["j29_measures_by_class_status"],
    "j34_passengers_by_year": """
        select cast(floor(id_tiempo / 10000.0) as int) as anio, count(*) as total_vuelos, count(distinct id_pasajero) as pasajeros_distintos
        from fl_hechos group by 1""",
    "j45_sliced_trend": f"""
        select anio, mes, ingresos_operativos_usd, ticket_promedio_usd, pasajeros_distintos from ({measures_sql(_TREND, ['anio', 'mes'])})""",
    "j45_sliced_top_airlines": f"""
        select nombre_aerolinea, ingresos_operativos_usd, pasajeros_distintos from ({measures_sql(f'(select * from {_F_A} where {_YEAR} and {_DONE})', ['nombre_aerolinea'])})
        order by ingresos_operativos_usd desc, nombre_aerolinea limit 10""",
    "j45_sliced_delay_by_origin": f"""
        select codigo_iata as aeropuerto_origen, count(*) as vuelos_operados, {_div('sum(retraso_minutos)', 'count(*)', 2)} as retraso_promedio_min
        from fl_hechos join fl_dim_aeropuerto on id_aeropuerto = id_aeropuerto_origen
        where {_YEAR} and {_AIR} and estado_vuelo in ('ON_TIME', 'DELAYED') group by codigo_iata""",
    "j45_sliced_top_destinations": f"""
        select codigo_iata as aeropuerto_destino, count(*) as total_vuelos from fl_hechos join fl_dim_aeropuerto on id_aeropuerto = id_aeropuerto_destino
        where {_YEAR} and {_DONE} and {_CLS} group by codigo_iata order by total_vuelos desc, aeropuerto_destino limit 5""",
    "j45_sliced_gender_share": f"""
        select genero, vuelos, {_div('vuelos', 'sum(vuelos) over ()', 2, ' * 100')} as porcentaje
        from (select genero, count(*) as vuelos from {_F_P} where {_AIR} and {_DONE} group by genero)""",
    "j45_sliced_channel_payment": f"""
        select c.canal_venta, p.metodo_pago, (select count(*) from fl_hechos x where {_YEAR} and x.canal_venta = c.canal_venta and x.metodo_pago = p.metodo_pago) as vuelos
        from (select distinct canal_venta from fl_hechos where {_YEAR}) c, (select distinct metodo_pago from fl_hechos) p""",
}


def flight_queries() -> dict[str, str]:
    return {k: with_ctes(v, FLIGHT_CTES) for k, v in FLIGHT_QUERIES.items()}
