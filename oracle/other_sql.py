"""Oracle SQL for the customer cleaning (J52-J55) and the retail BI model."""

from __future__ import annotations

from oracle.ctes import with_ctes


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^\\s+', ''), '\\s+$', '')"


def _sentinel(c: str) -> str:
    return f"case when {c} in ('Nan', 'None') then '' else {c} end"


def _title1(c: str) -> str:
    """Title case of a single-token string (the test data has no inner spaces)."""
    return f"concat(upper(substring({c}, 1, 1)), lower(substring({c}, 2)))"


def _div(a: str, b: str, scale: int, factor: str = "") -> str:
    return (f"cast(round(cast(cast({a} as double) / nullif(cast({b} as double), 0){factor} as decimal(24,8)), {scale})"
            f" as decimal(18,{scale}))")


CUSTOMER_CTES = [
    ("fx_cliente_sucio", """
        select c.c_custkey as id_cliente,
               case cast(c.c_custkey % 3 as int) when 0 then upper(c.c_name) when 1 then concat('  ', lower(c.c_name), ' ')
                    else c.c_name end as nombre,
               case cast(c.c_custkey % 5 as int) when 0 then 'm' when 1 then ' M ' when 2 then 'f' when 3 then 'F ' else '' end
                   as genero,
               case when cast(c.c_custkey % 2 as int) = 0 then cast(date '2026-01-13' + cast(c.c_custkey % 15 as int) as varchar)
                    else concat(cast(13 + cast(c.c_custkey % 15 as int) as varchar), '/02/2026') end as fecha_registro,
               case when cast(c.c_custkey % 10 as int) = 0 then null
                    when cast(c.c_custkey % 3 as int) = 0 then replace(cast(cast(c.c_acctbal as decimal(12,2)) as varchar), '.', ',')
                    else cast(cast(c.c_acctbal as decimal(12,2)) as varchar) end as gasto_q,
               case when cast(c.c_custkey % 30 as int) = 0 then null when cast(c.c_custkey % 31 as int) = 0 then ''
                    else concat(' ', lower(n.n_name)) end as ciudad,
               c.c_mktsegment as categoria
        from customer c join nation n on c.c_nationkey = n.n_nationkey"""),
    ("cu_raw", """
        select *, id_cliente * 2 as _row_number from fx_cliente_sucio
        union all
        select id_cliente, concat(nombre, ' DUP'), genero, fecha_registro, gasto_q, ciudad, categoria, id_cliente * 2 + 1
        from fx_cliente_sucio where id_cliente % 50 = 0"""),
    ("cu_dedup", """
        select * exclude (rn) from (select *, row_number() over (partition by id_cliente order by _row_number) as rn from cu_raw)
        where rn = 1"""),
    ("cu_std", f"""
        select id_cliente,
               {_sentinel(_title1(_strip('nombre')))} as nombre, {_sentinel(_strip('genero'))} as genero,
               {_sentinel(_strip('fecha_registro'))} as fecha_registro, {_sentinel(_strip('gasto_q'))} as gasto_q,
               {_sentinel(_title1(_strip('ciudad')))} as ciudad, {_sentinel(_title1(_strip('categoria')))} as categoria
        from cu_dedup"""),
    ("cu_clean", """
        select id_cliente, nombre,
               case lower(genero) when 'm' then 'Masculino' when 'f' then 'Femenino' else 'No especificado' end as genero,
               cast(coalesce(try_strptime(nullif(trim(fecha_registro), ''), '%Y-%m-%d'),
                             try_strptime(nullif(trim(fecha_registro), ''), '%d/%m/%Y')) as date) as fecha_registro,
               try_cast(replace(gasto_q, ',', '.') as decimal(12,2)) as gasto_q,
               coalesce(nullif(ciudad, ''), 'Desconocida') as ciudad, categoria
        from cu_std
        where coalesce(try_strptime(nullif(trim(fecha_registro), ''), '%Y-%m-%d'),
                       try_strptime(nullif(trim(fecha_registro), ''), '%d/%m/%Y')) is not null"""),
]

_CATS = ["Automobile", "Building", "Furniture", "Household", "Machinery"]
_GENDERS = ["Femenino", "Masculino", "No especificado"]

CUSTOMER_QUERIES = {
    "b10_clean_customers": "select * from cu_clean",
    "a16_customers_export": """select id_cliente, nombre, genero, fecha_registro,
                                      cast(coalesce(gasto_q, 0) as decimal(12,2)) as gasto_q, ciudad, categoria from cu_clean""",
    "f05_dedup_first": "select id_cliente, nombre, _row_number from cu_dedup",
    "g04_first_rows_sample": "select * from cu_raw order by _row_number limit 15",
    "j52_spend_city_category": "select ciudad, " + ", ".join(
        f"cast(coalesce({_div(f'sum(gasto_q) filter (where categoria = {chr(39)}{v}{chr(39)})', f'count(gasto_q) filter (where categoria = {chr(39)}{v}{chr(39)})', 2)}, 0)"
        f" as decimal(18,2)) as \"{v}\"" for v in _CATS)
        + " from cu_clean where ciudad is not null and categoria is not null group by ciudad",
    "j53_customers_city_gender": "select ciudad, " + ", ".join(
        f"count(id_cliente) filter (where genero = '{v}') as \"{v}\"" for v in _GENDERS)
        + " from cu_clean where ciudad is not null and genero is not null group by ciudad",
    "j54_mean_spend_by_category": f"""
        select categoria, {_div('sum(gasto_q)', 'count(gasto_q)', 2)} as gasto_promedio from cu_clean group by categoria""",
    "j54_gender_share": f"""
        select genero, count(*) as cantidad, {_div('count(*)', '(select count(*) from cu_clean)', 4)} as proporcion
        from cu_clean group by genero""",
    "j55_cleaning_report": """
        select (select count(*) from cu_raw) as filas_entrada,
               (select count(*) from cu_raw) - (select count(*) from cu_dedup) as duplicados_eliminados,
               (select count(*) from cu_dedup) - count(*) as filas_sin_fecha_eliminadas,
               count(*) as filas_salida,
               count(*) filter (where genero = 'No especificado') as genero_no_especificado,
               count(*) filter (where ciudad = 'Desconocida') as ciudad_desconocida,
               count(*) filter (where gasto_q is null) as gasto_nulo_a_cero
        from cu_clean""",
}

RETAIL_CTES = [
    ("rt_customers", "select c_custkey as customer_id, trim(c_name) as customer_name, c_mktsegment as segment from customer"),
    ("rt_products", """select p_partkey as product_id, trim(p_name) as product_name, trim(p_type) as category,
                              trim(p_brand) as sub_category from part"""),
    ("rt_orders", """
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
               cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as ship_date,
               case cast(o_orderkey % 4 as int) when 0 then 'First Class' when 1 then 'Same Day' when 2 then 'Standard Class'
                    else 'Second Class' end as ship_mode
        from orders"""),
    ("rt_details", """
        select l.id_venta as order_id, l.id_producto as product_id, l.monto_neto as sales, l.cantidad as quantity,
               l.descuento_pct as discount, cast(l.monto_neto - round(l.cantidad * p.costo_base, 2) as decimal(14,2)) as profit
        from stg_venta_detalle l left join stg_producto p on p.id_producto = l.id_producto"""),
    ("rt_deliveries", """
        select o_orderkey as delivery_id, o_orderkey as order_id, cast(o_orderdate as date) + 7 as estimated_delivery_date,
               cast(o_orderdate as date) + cast(o_orderkey % 15 as int) as actual_delivery_date,
               case cast(o_orderkey % 4 as int) when 0 then 'Delivered' when 1 then 'Delayed' when 2 then 'Failed'
                    else 'In Transit' end as status,
               cast(cast(o_orderkey % 15 as int) - 7 as int) as dias_retraso
        from orders"""),
]

RETAIL_QUERIES = {
    "h20_order_lines_model": """
        select d.*, o.customer_id, o.order_date, o.ship_date, o.ship_mode, c.customer_name, c.segment,
               p.product_name, p.category, p.sub_category
        from rt_details d join rt_orders o on o.order_id = d.order_id join rt_customers c on c.customer_id = o.customer_id
        join rt_products p on p.product_id = d.product_id""",
    "j46_totals": f"""
        select cast(sum(sales) as decimal(38,2)) as ventas_totales, cast(sum(profit) as decimal(38,2)) as utilidad_total,
               {_div('sum(profit)', 'sum(sales)', 2, ' * 100')} as margen_pct
        from rt_details""",
    "j47_by_category": f"""
        select category, ventas, utilidad, {_div('utilidad', 'ventas', 2, ' * 100')} as margen_pct,
               {_div('ventas', 'sum(ventas) over ()', 2, ' * 100')} as participacion_pct
        from (select p.category, cast(sum(d.sales) as decimal(38,2)) as ventas, cast(sum(d.profit) as decimal(38,2)) as utilidad
              from rt_details d join rt_products p on p.product_id = d.product_id group by p.category)""",
    "j48_sales_by_month": """
        select strftime(o.order_date, '%Y-%m') as anio_mes, cast(sum(d.sales) as decimal(38,2)) as ventas
        from rt_details d join rt_orders o on o.order_id = d.order_id group by 1""",
    "j49_sales_by_segment": f"""
        select segment, ventas, {_div('ventas', 'sum(ventas) over ()', 2, ' * 100')} as participacion_pct
        from (select c.segment, cast(sum(d.sales) as decimal(38,2)) as ventas
              from rt_details d join rt_orders o on o.order_id = d.order_id join rt_customers c on c.customer_id = o.customer_id
              group by c.segment)""",
    "j50_orders_by_ship_mode": "select ship_mode, count(*) as ordenes from rt_orders group by ship_mode",
    "j51_delivery_status": f"""
        select status, entregas, {_div('entregas', 'sum(entregas) over ()', 2, ' * 100')} as participacion_pct,
               {_div('d', 'entregas', 2)} as dias_retraso_promedio
        from (select status, count(*) as entregas, sum(dias_retraso) as d from rt_deliveries group by status)""",
}


def other_queries() -> dict[str, str]:
    out = {k: with_ctes(v, CUSTOMER_CTES) for k, v in CUSTOMER_QUERIES.items()}
    out.update({k: with_ctes(v, RETAIL_CTES) for k, v in RETAIL_QUERIES.items()})
    out.update(incremental_queries())
    return out


_B1 = "(select * from events where ts < timestamp '2024-01-21 00:00:00')"
_B2 = (f"(select event_id, ts, user_id, event_type, value + 1000.0 as value, props from events "
       f"where ts >= (select max(ts) from {_B1}) - interval 2 day)")
_MERGED = f"select * from {_B1} b1 where event_id not in (select event_id from {_B2}) union all select * from {_B2}"

INCREMENTAL_QUERIES = {
    "a02_extract_since": f"select * from events where ts >= (select max(ts) from {_B1}) - interval 2 day",
    "a03_extract_child_since": """
        select * from stg_venta_detalle where id_venta in (select id_venta from stg_venta where fecha_venta >= date '2001-01-01')""",
    "a10_merge_load": _MERGED,
    "k01_stream_upsert": _MERGED,
    "a12_watermark": f"""
        select 'events' as source_name, 'ts' as watermark_col, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_value from {_B2}""",
    "a13_reconcile": """
        select 'venta_detalle' as tabla, (select count(*) from fx_linea) as filas_origen,
               (select count(*) from stg_venta_detalle) as filas_destino,
               (select count(*) from fx_linea) = (select count(*) from stg_venta_detalle) as cuadra""",
    "a09_full_load": "select * from stg_cliente",
    "a04_csv_contract": "select nullif(trim(columns(*)::varchar), '') from stg_cliente",
    "a07_csv_positional": "select cast(p_partkey as varchar) as codigo, p_name as nombre, p_brand as marca from part",
    "a08_csv_infer": "select p_partkey, cast(p_size as bigint) as p_size, p_name, 'int,int,string' as tipos from part",
    "a11_stamp": "select id_cliente, 'lote-1' as _batch_id, 'cliente' as _source from stg_cliente",
    "a18_conform_dim_sucursal": "select * from dim_sucursal",
    "a19_freshness": """
        select mx as max_loaded_at,
               cast(round(cast((epoch(mx + interval 30 hour) - epoch(mx)) / 3600.0 as decimal(24,8)), 2) as decimal(18,2)) as horas,
               case when (epoch(mx + interval 30 hour) - epoch(mx)) / 3600.0 > 48 then 'error'
                    when (epoch(mx + interval 30 hour) - epoch(mx)) / 3600.0 > 24 then 'warn' else 'pass' end as estado
        from (select max(ts) as mx from events)""",
}


def incremental_queries() -> dict[str, str]:
    from oracle.flights_sql import FLIGHT_CTES

    out = {k: with_ctes(v) for k, v in INCREMENTAL_QUERIES.items()}
    out["a20_insert_missing"] = with_ctes("""
        select md5(concat_ws('-', coalesce(cast(cod_aerolinea as varchar), '<null>'))) as id_aerolinea, cod_aerolinea, nom_aerolinea
        from (select distinct cod_aerolinea, nom_aerolinea from fl_clean)""", FLIGHT_CTES)
    return out
