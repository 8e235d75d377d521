"""Independent SQL (DuckDB) definition of the warehouse, for the correctness oracle.

Written from the rules in their own terms: keys are computed from natural keys
and checked for membership, promotions and recent sales are correlated
subqueries, goals sum one list of movements.
``with_ctes(body)`` prefixes a query with every relation below; DuckDB
inlines the CTEs a query does not use.
"""

from __future__ import annotations

def _key(*cols: str) -> str:
    """Surrogate key of natural key columns."""
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({c} as varchar), '<null>')" for c in cols) + "))"


def _member(col: str, relation: str) -> str:
    """Its key where the relation has the member, else that of the unknown member."""
    return f"case when {col} in (select {col} from {relation}) then {_key(col)} else md5('-1') end"


def _day(col: str) -> str:
    """Key of a day of the calendar, else -1."""
    return f"case when {col} in (select fecha from dim_fecha) then cast(strftime({col}, '%Y%m%d') as int) else -1 end"


def _ratio(a: str, b: str) -> str:
    return f"cast(round(cast(cast({a} as double) / nullif(cast({b} as double), 0) as decimal(24,8)), 4) as decimal(18,4))"


def _typed() -> str:
    """The measures of a sale line in the declared types."""
    widths = {"precio_unitario": "12,2", "descuento_pct": "5,4", "monto_bruto": "14,2", "monto_descuento": "14,2", "monto_neto": "14,2",
              "costo_unitario": "12,2", "costo_total": "14,2", "margen_bruto": "14,2"}
    return ", ".join(f"cast({c} as decimal({w})) as {c}" for c, w in widths.items())


_CTES = [
    # ------------------------------------------------------------ role mapping
    ("fx_sucursal", """
        select n.n_nationkey as id_sucursal, n.n_name as nombre,
               concat('C', cast(n.n_nationkey as varchar)) as ciudad, r.r_name as departamento
        from nation n join region r on n.n_regionkey = r.r_regionkey"""),
    ("fx_producto", """
        select p_partkey as id_producto,
               concat(' sku', cast(p_partkey as varchar)) as sku,
               p_name as nombre, p_type as categoria, p_brand as marca,
               case cast(p_size % 4 as int) when 0 then 'Caja ' when 1 then ' unidad' when 2 then 'PAQUETE' else 'botella' end
                   as unidad_medida,
               cast(round(cast(p_retailprice as decimal(12,2)) * cast(55 + cast(p_partkey % 30 as int) as decimal(3,0))
                          * cast(0.01 as decimal(3,2)), 2) as decimal(12,2)) as costo_base,
               cast(p_retailprice as decimal(12,2)) as precio_lista,
               cast(p_size % 10 as int) <> 0 as activo
        from part"""),
    ("fx_cliente", """
        select c.c_custkey as id_cliente, concat('NIT', cast(c.c_custkey as varchar)) as nit, c.c_name as nombre,
               c.c_mktsegment as tipo_cliente, n.n_name as municipio, r.r_name as departamento,
               date '1995-01-01' + cast(c.c_custkey % 700 as int) as fecha_alta
        from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey"""),
    ("fx_venta", """
        select o.o_orderkey as id_venta, cast(o.o_orderdate as date) as fecha, o.o_custkey as id_cliente,
               c.c_nationkey as id_sucursal,
               case cast(o.o_orderkey % 4 as int) when 0 then 'Tienda' when 1 then 'Mayorista' when 2 then 'Televenta' else 'Web' end
                   as canal,
               o.o_orderpriority as metodo_pago,
               case o.o_orderstatus when 'F' then 'Completada ' when 'O' then 'PENDIENTE' when 'P' then 'anulada' end as estado
        from orders o join customer c on o.o_custkey = c.c_custkey"""),
    ("fx_linea", """
        select md5(concat(cast(l.l_orderkey as varchar), '-', cast(l.l_partkey as varchar), '-', cast(l.l_suppkey as varchar), '-',
                          cast(l.l_linenumber as varchar), '-', cast(cast(l.l_shipdate as date) as varchar), '-',
                          cast(cast(l.l_extendedprice as decimal(14,2)) as varchar))) as id_detalle,
               l.l_orderkey as id_venta, l.l_partkey as id_producto, l.l_suppkey as id_proveedor, l.l_linenumber as num_linea,
               cast(l.l_quantity as int) as cantidad, p.precio_lista as precio_unitario,
               cast(l.l_discount as decimal(5,4)) as descuento,
               cast(round(cast(l.l_quantity as int) * p.precio_lista * (1 - cast(l.l_discount as decimal(5,4))), 2) as decimal(14,2))
                   as subtotal,
               l.l_returnflag, cast(l.l_shipdate as date) as fecha_envio
        from lineitem l join fx_producto p on l.l_partkey = p.id_producto"""),
    ("fx_promocion", """
        select id_promocion, concat('Promo ', cast(id_promocion as varchar), ' ', categoria) as nombre,
               cast(fi as date) as fecha_inicio, cast(ff as date) as fecha_fin, categoria,
               cast(pct as decimal(5,4)) as porcentaje_descuento
        from (values (1, 'PROMO', '1996-01-01', '1996-03-31', '0.05'), (2, 'PROMO', '1996-03-01', '1996-06-30', '0.15'),
                     (3, 'PROMO', '1996-03-15', '1996-04-15', '0.15'), (4, 'ECONOMY', '1997-01-01', '1997-12-31', '0.10'),
                     (5, 'ECONOMY', '1997-06-01', '1997-06-30', '0.05'), (6, 'SMALL', '1998-02-01', '1998-02-28', '0.20'),
                     (7, 'LARGE', '1999-01-01', '1999-06-30', '0.10'), (8, 'LARGE', '1999-06-30', '1999-09-30', '0.12'),
                     (9, 'MEDIUM', '2000-05-05', '2000-05-05', '0.25'), (10, 'STANDARD', '2001-01-01', '2001-12-31', '0.08'))
             t(id_promocion, categoria, fi, ff, pct)
        where exists (select 1 from part where split_part(trim(p_type), ' ', 1) = t.categoria)"""),
    ("fx_devolucion", """
        select l.id_detalle as id_devolucion,
               v.fecha + cast(case when cast(l.id_venta % 70 as int) = 0 then -1 else l.num_linea * 3 end as int) as fecha,
               l.id_venta, l.id_producto,
               cast(case when cast(l.id_venta % 50 as int) = 0 then l.cantidad + 1 else greatest(1, l.cantidad - 3) end as int)
                   as cantidad,
               case cast(l.num_linea % 5 as int) when 0 then 'Vencimiento cercano' when 1 then 'Error de despacho'
                    when 2 then 'Cliente desistió' when 3 then 'Producto dañado' else 'Empaque defectuoso' end as motivo
        from fx_linea l join fx_venta v on l.id_venta = v.id_venta
        where l.l_returnflag = 'R'"""),
    ("fx_meta", """
        select m.periodo, s.id_sucursal,
               cast(50000 + 1000 * s.id_sucursal + 500 * cast(substring(m.periodo, 6, 2) as int) as decimal(14,2)) as meta_ventas,
               cast(1000 + 10 * s.id_sucursal as int) as meta_unidades
        from (select distinct substring(cast(fecha as varchar), 1, 7) as periodo from fx_venta) m cross join fx_sucursal s"""),
    ("fx_inventario", """
        select g.fecha_corte, g.id_sucursal, g.id_producto,
               cast((7 * g.id_producto + 13 * g.id_sucursal + 5 * month(g.fecha_corte)) % 120 as int) as stock_disponible,
               cast(10 + g.id_producto % 15 as int) as stock_minimo,
               cast(70 + g.id_sucursal % 30 as int) as stock_maximo,
               concat('l', cast(g.id_producto as varchar), '-', cast(g.id_sucursal as varchar)) as lote,
               g.fecha_corte + cast((g.id_producto + g.id_sucursal + month(g.fecha_corte)) % 200 - 3 as int) as fecha_vencimiento
        from (select last_day(cast(o.o_orderdate as date)) as fecha_corte, c.c_nationkey as id_sucursal, l.l_partkey as id_producto
              from lineitem l, orders o, customer c, part p
              where l.l_orderkey = o.o_orderkey and o.o_custkey = c.c_custkey and l.l_partkey = p.p_partkey
              group by all) g"""),
    ("fx_proveedor_precio", """
        select f.id_proveedor, s.s_name as proveedor, f.id_producto,
               case when cast(f.id_proveedor % 97 as int) = 0 then cast(null as decimal(12,2))
                    else cast(round(p.precio_lista * cast(50 + cast(f.id_proveedor % 40 as int) as decimal(3,0))
                                    * cast(0.01 as decimal(3,2)), 2) as decimal(12,2)) end as costo_proveedor,
               cast(1 + cast(f.id_proveedor % 30 as int) as int) as plazo_dias,
               f.fecha_vigencia
        from (select l_suppkey as id_proveedor, l_partkey as id_producto, min(cast(l_shipdate as date)) as fecha_vigencia
              from lineitem group by 1, 2) f
        join supplier s on f.id_proveedor = s.s_suppkey
        join fx_producto p on f.id_producto = p.id_producto"""),
    # ----------------------------------------------------------------- staging
    ("stg_sucursal", """select id_sucursal, trim(nombre) as nombre_sucursal, trim(ciudad) as ciudad,
                               trim(departamento) as departamento from fx_sucursal"""),
    ("stg_producto", """select id_producto, upper(trim(sku)) as sku, trim(nombre) as nombre_producto, trim(categoria) as categoria,
                               trim(marca) as marca, lower(trim(unidad_medida)) as unidad_medida, costo_base, precio_lista, activo
                        from fx_producto"""),
    ("stg_categoria", "select distinct md5(trim(p_type)) as id_categoria, trim(p_type) as categoria from part"),
    ("stg_marca", "select distinct md5(trim(p_brand)) as id_marca, trim(p_brand) as marca from part"),
    ("stg_cliente", """select id_cliente, trim(nit) as nit, trim(nombre) as nombre_cliente, trim(tipo_cliente) as tipo_cliente,
                              trim(municipio) as municipio, trim(departamento) as departamento, fecha_alta from fx_cliente"""),
    ("stg_venta", """select id_venta, fecha as fecha_venta, id_cliente, id_sucursal, trim(canal) as canal,
                            trim(metodo_pago) as metodo_pago, upper(trim(estado)) as estado_venta from fx_venta"""),
    ("stg_venta_detalle", """select id_detalle, id_venta, id_producto, cantidad, precio_unitario, descuento as descuento_pct,
                                    subtotal as monto_neto from fx_linea"""),
    ("stg_promociones", """select id_promocion, nombre as nombre_promocion, fecha_inicio, fecha_fin, categoria,
                                  porcentaje_descuento from fx_promocion"""),
    ("stg_devoluciones", """select id_devolucion, fecha as fecha_devolucion, id_venta, id_producto,
                                   cantidad as cantidad_devuelta, motivo from fx_devolucion"""),
    ("stg_metas", """select periodo as anio_mes, cast(concat(periodo, '-01') as date) as fecha_mes, id_sucursal,
                            meta_ventas, meta_unidades from fx_meta"""),
    ("stg_inventario", """select fecha_corte, id_sucursal, id_producto, stock_disponible, stock_minimo, stock_maximo,
                                 upper(lote) as lote, fecha_vencimiento from fx_inventario"""),
    ("stg_proveedores_precios", """select id_proveedor, proveedor as nombre_proveedor, id_producto, costo_proveedor,
                                          cast(plazo_dias as smallint) as plazo_dias, fecha_vigencia from fx_proveedor_precio"""),
    # ------------------------------------------------------------ dimensions
    ("dim_fecha", """
        select cast(strftime(fecha, '%Y%m%d') as int) as sk_fecha, fecha,
               cast(year(fecha) as int) as anio, cast(quarter(fecha) as int) as trimestre, cast(month(fecha) as int) as mes,
               ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][month(fecha)]
                   as nombre_mes,
               strftime(fecha, '%Y-%m') as anio_mes, cast(weekofyear(fecha) as int) as semana_iso,
               cast(day(fecha) as int) as dia_mes, cast(isodow(fecha) as int) as dia_semana_iso,
               ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(fecha)] as nombre_dia,
               isodow(fecha) in (6, 7) as es_fin_de_semana
        from (select cast(unnest(generate_series(date_trunc('year', least(o1, s1) - 1), make_date(cast(year(greatest(o2, s2)) + 1 as int), 12, 31),
                                                 interval 1 day)) as date) as fecha
              from (select cast(min(o_orderdate) as date) as o1, cast(max(o_orderdate) as date) as o2 from orders),
                   (select cast(min(l_shipdate) as date) as s1, cast(max(l_shipdate) as date) as s2 from lineitem))
        union all
        select -1, null, null, null, null, 'Desconocido', null, null, null, null, 'Desconocido', null"""),
    ("dim_sucursal", """
        select md5(concat_ws('-', coalesce(cast(id_sucursal as varchar), '<null>'))) as sk_sucursal,
               cast(id_sucursal as bigint) as id_sucursal, nombre_sucursal, ciudad, departamento from stg_sucursal
        union all select md5('-1'), -1, 'Desconocida', null, null"""),
    ("int_productos", """
        select *, case when precio_lista > 0 then cast(round(cast(cast(precio_lista - costo_base as double)
                        / nullif(cast(precio_lista as double), 0) as decimal(24,8)), 4) as decimal(7,4)) end as margen_lista_pct
        from stg_producto"""),
    ("dim_producto", """
        select md5(concat_ws('-', coalesce(cast(id_producto as varchar), '<null>'))) as sk_producto, cast(id_producto as bigint) as id_producto,
               sku, nombre_producto, categoria, marca, unidad_medida, costo_base, precio_lista,
               cast(margen_lista_pct as decimal(7,4)) as margen_lista_pct, activo
        from int_productos
        union all select md5('-1'), -1, null, 'Desconocido', 'Desconocida', 'Desconocida', null, null, null, null, null"""),
    ("dim_cliente", """
        select md5(concat_ws('-', coalesce(cast(id_cliente as varchar), '<null>'))) as sk_cliente, cast(id_cliente as bigint) as id_cliente,
               nit, nombre_cliente, tipo_cliente, municipio, departamento, fecha_alta from stg_cliente
        union all select md5('-1'), -1, null, 'Desconocido', 'Desconocido', null, null, null"""),
    ("dim_proveedor", """
        select md5(concat_ws('-', coalesce(cast(id_proveedor as varchar), '<null>'))) as sk_proveedor, id_proveedor, nombre_proveedor
        from (select id_proveedor, max(nombre_proveedor) as nombre_proveedor from stg_proveedores_precios group by id_proveedor)
        union all select md5('-1'), -1, 'Desconocido'"""),
    ("dim_promocion", """
        select md5(concat_ws('-', coalesce(cast(id_promocion as varchar), '<null>'))) as sk_promocion, id_promocion, nombre_promocion,
               categoria, fecha_inicio, fecha_fin, porcentaje_descuento,
               cast(date_diff('day', fecha_inicio, fecha_fin) + 1 as int) as duracion_dias
        from stg_promociones
        union all select md5('-1'), -1, 'Sin promoción', null, null, null, 0, null"""),
    ("dim_condicion_venta", """
        select md5(concat_ws('-', coalesce(canal, '<null>'), coalesce(metodo_pago, '<null>'), coalesce(estado_venta, '<null>')))
                   as sk_condicion_venta, canal, metodo_pago, estado_venta
        from (select distinct canal, metodo_pago, estado_venta from stg_venta)
        union all select md5('-1'), 'Desconocido', 'Desconocido', 'Desconocido'"""),
    # ---------------------------------------------------------- intermediate
    # a line's promotion is the one with no better rival on its day: a higher discount, or as high and a smaller id
    ("int_ventas_lineas", """
        select x.*, x.monto_bruto - x.monto_neto as monto_descuento, x.monto_neto - x.costo_total as margen_bruto
        from (
          select id_detalle, id_venta, fecha_venta, id_cliente, id_sucursal, canal, metodo_pago, estado_venta, id_producto, categoria,
                 cantidad, precio_unitario, descuento_pct, monto_neto, costo_base as costo_unitario,
                 (select min(q.id_promocion) from stg_promociones q
                  where q.categoria = stg_producto.categoria and q.fecha_inicio <= fecha_venta and q.fecha_fin >= fecha_venta
                    and q.porcentaje_descuento = (select max(r.porcentaje_descuento) from stg_promociones r
                                                  where r.categoria = stg_producto.categoria and r.fecha_inicio <= fecha_venta
                                                    and r.fecha_fin >= fecha_venta)) as id_promocion,
                 round(cantidad * precio_unitario, 2) as monto_bruto, round(cantidad * costo_base, 2) as costo_total,
                 estado_venta is not distinct from 'COMPLETADA' as es_venta_valida
          from stg_venta_detalle left join stg_venta using (id_venta) left join stg_producto using (id_producto)) x"""),
    # each return against the lines of its sale and product, valued in one aggregate
    ("int_devoluciones", """
        select r.*,
               cast(round(cast(neto / nullif(vendidas, 0) as decimal(24,8)), 4) as decimal(12,4)) as precio_neto_unitario,
               cast(round(cast(cast(cantidad_devuelta as double) * neto / nullif(vendidas, 0) as decimal(24,8)), 2) as decimal(14,2))
                   as monto_devuelto,
               cast(fecha_devolucion - fecha_venta as int) as dias_desde_venta
        from (
          select d.id_devolucion, d.fecha_devolucion, d.id_venta, d.id_producto, d.cantidad_devuelta, d.motivo,
                 min(l.fecha_venta) as fecha_venta, min(l.id_cliente) as id_cliente, min(l.id_sucursal) as id_sucursal,
                 cast(sum(l.cantidad) as double) as vendidas, cast(sum(l.monto_neto) as double) as neto
          from stg_devoluciones d left join int_ventas_lineas l using (id_venta, id_producto) group by all) r"""),
    # cheapest: as cheap as the cheapest offer of the product, or none of them has a price
    ("int_costos_proveedor", """
        select id_proveedor, nombre_proveedor, id_producto, fecha_vigencia, costo_proveedor, plazo_dias, costo_base_producto,
               cast(costo_proveedor - costo_base_producto as decimal(12,2)) as diferencia_vs_costo_base,
               costo_proveedor is not distinct from menor as es_proveedor_mas_barato
        from (select *, (select min(costo_base) from stg_producto base where base.id_producto = oferta.id_producto) as costo_base_producto,
                     min(costo_proveedor) over (partition by id_producto) as menor
              from stg_proveedores_precios oferta)"""),
    # ------------------------------------------------------------------ facts
    ("fct_ventas", f"""
        select id_detalle, id_venta, {_day('fecha_venta')} as sk_fecha, {_member('id_cliente', 'stg_cliente')} as sk_cliente,
               {_member('id_producto', 'stg_producto')} as sk_producto, {_member('id_sucursal', 'stg_sucursal')} as sk_sucursal,
               case when num_nulls = 0 then {_key('canal', 'metodo_pago', 'estado_venta')} else md5('-1') end as sk_condicion_venta,
               {_member('id_promocion', 'stg_promociones')} as sk_promocion, cantidad, {_typed()}, es_venta_valida
        from (select *, len(list_filter([canal, metodo_pago, estado_venta], lambda c: c is null)) as num_nulls from int_ventas_lineas)"""),
    ("fct_devoluciones", f"""
        select id_devolucion, id_venta, {_day('fecha_devolucion')} as sk_fecha, {_day('fecha_venta')} as sk_fecha_venta,
               {_member('id_producto', 'stg_producto')} as sk_producto, {_member('id_cliente', 'stg_cliente')} as sk_cliente,
               {_member('id_sucursal', 'stg_sucursal')} as sk_sucursal, motivo, cantidad_devuelta, precio_neto_unitario, monto_devuelto,
               dias_desde_venta
        from int_devoluciones"""),
    ("fct_inventario_mensual", f"""
        select {_key('fecha_corte', 'id_sucursal', 'id_producto')} as sk_inventario, {_day('fecha_corte')} as sk_fecha_corte,
               {_member('id_sucursal', 'stg_sucursal')} as sk_sucursal, {_member('id_producto', 'stg_producto')} as sk_producto,
               {_day('fecha_vencimiento')} as sk_fecha_vencimiento, lote, stock_disponible, stock_minimo, stock_maximo, costo_unitario,
               cast(stock_disponible * costo_unitario as decimal(14,2)) as valor_inventario,
               cast(fecha_vencimiento - fecha_corte as int) as dias_para_vencer,
               stock_disponible = 0 as es_sin_stock, stock_disponible < stock_minimo as es_bajo_minimo,
               stock_disponible > stock_maximo as es_sobre_maximo
        from (select i.*, (select cast(min(p.costo_base) as decimal(12,2)) from stg_producto p where p.id_producto = i.id_producto)
                          as costo_unitario from stg_inventario i)"""),
    ("fct_metas_ventas", f"""
        select {_day('fecha_mes')} as sk_fecha_mes, {_member('id_sucursal', 'stg_sucursal')} as sk_sucursal, anio_mes, meta_ventas, meta_unidades
        from stg_metas"""),
    # every supplier is known from its own offers
    ("fct_costos_proveedor", f"""
        select case when id_proveedor is null then md5('-1') else {_key('id_proveedor')} end as sk_proveedor,
               {_member('id_producto', 'stg_producto')} as sk_producto, {_day('fecha_vigencia')} as sk_fecha_vigencia,
               costo_proveedor, plazo_dias, cast(costo_base_producto as decimal(12,2)) as costo_base_producto,
               diferencia_vs_costo_base, es_proveedor_mas_barato
        from int_costos_proveedor"""),
    # ------------------------------------------------------------------ marts
    # sales and returns as one list of signed movements by branch and month; goals pick their sums
    ("mart_cumplimiento_metas", f"""
        select anio_mes, id_sucursal, nombre_sucursal, meta_ventas, meta_unidades, venta_neta, monto_devuelto,
               cast(venta_neta - monto_devuelto as decimal(38,2)) as venta_neta_menos_devoluciones, unidades_vendidas, num_ventas,
               margen_bruto, {_ratio('venta_neta', 'meta_ventas')} as pct_cumplimiento_ventas,
               {_ratio('unidades_vendidas', 'meta_unidades')} as pct_cumplimiento_unidades, venta_neta >= meta_ventas as cumplio_meta_ventas
        from (
          select g.anio_mes, s.id_sucursal, s.nombre_sucursal, g.meta_ventas, g.meta_unidades,
                 cast(coalesce(sum(x.neto), 0) as decimal(38,2)) as venta_neta,
                 cast(coalesce(sum(x.devuelto), 0) as decimal(38,2)) as monto_devuelto,
                 cast(coalesce(sum(x.unidades), 0) as bigint) as unidades_vendidas, count(distinct x.id_venta) as num_ventas,
                 cast(coalesce(sum(x.margen), 0) as decimal(38,2)) as margen_bruto
          from stg_metas g join dim_sucursal s on s.id_sucursal = g.id_sucursal
          left join (
            select id_sucursal, strftime(fecha_venta, '%Y-%m') as mes, id_venta, monto_neto as neto, cantidad as unidades,
                   margen_bruto as margen, null as devuelto
            from int_ventas_lineas where es_venta_valida
            union all
            select id_sucursal, strftime(fecha_devolucion, '%Y-%m'), null, null, null, null, monto_devuelto from int_devoluciones
          ) x on x.id_sucursal = g.id_sucursal and x.mes = g.anio_mes
          group by all) t"""),
    # the newest cut-off, with the units sold in the three months up to it by correlated sums
    ("mart_alertas_inventario", f"""
        select fecha_corte, nombre_sucursal, sku, nombre_producto, categoria, stock_disponible, stock_minimo, stock_maximo,
               valor_inventario, dias_para_vencer,
               coalesce(cast(round(cast(cast(vendidas as double) / 3.0 as decimal(24,8)), 2) as decimal(18,2)), 0) as unidades_promedio_mes,
               cast(round(cast(cast(stock_disponible as double) / nullif(cast(vendidas as double) / 3.0, 0) as decimal(24,8)), 2)
                    as decimal(18,2)) as meses_cobertura,
               ['OK', 'SOBRE STOCK', 'BAJO MÍNIMO', 'SIN STOCK'][
                 1 + greatest(3 * cast(stock_disponible = 0 as int), 2 * cast(stock_disponible < stock_minimo as int),
                              cast(stock_disponible > stock_maximo as int))] as estado_stock,
               dias_para_vencer <= 60 as vence_en_60_dias
        from (
          select i.*, s.nombre_sucursal, p.sku, p.nombre_producto, p.categoria,
                 cast(i.stock_disponible * p.costo_base as decimal(14,2)) as valor_inventario,
                 cast(i.fecha_vencimiento - i.fecha_corte as int) as dias_para_vencer,
                 (select sum(l.cantidad) from int_ventas_lineas l
                  where l.es_venta_valida and l.id_sucursal = i.id_sucursal and l.id_producto = i.id_producto
                    and l.fecha_venta <= i.fecha_corte and l.fecha_venta > cast(i.fecha_corte - interval 3 month as date)) as vendidas
          from stg_inventario i join stg_sucursal s using (id_sucursal) join stg_producto p using (id_producto)
          where i.fecha_corte >= all (select fecha_corte from stg_inventario)) t"""),
]


def with_ctes(body: str, extra=()) -> str:
    parts = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in list(_CTES) + list(extra))
    body = body.strip()
    if body[:5].lower() == "with ":
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"


def cte_names() -> list[str]:
    return [n for n, _ in _CTES]
