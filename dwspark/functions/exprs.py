"""Scalar expressions B18-B28 and calendar parts.

Decimal discipline (money is decimal, never double):

* ratios divide as double and go through ``decimal(24,8)`` before the final
  ``round`` so that the result does not depend on binary rounding of a double;
* sums of decimals are widened to ``decimal(38,s)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c, p: int, s: int) -> Column:
    return _c(c).cast(f"decimal({p},{s})")


def days_between(later, earlier) -> Column:
    """Integer day difference (B18); ``date - date`` is an interval in Spark."""
    return F.datediff(_c(later), _c(earlier))


def line_measures(qty="cantidad", price="precio_unitario", net="monto_neto", unit_cost="costo_unitario") -> dict:
    """Gross, discount, cost and margin of a sale line."""
    gross = F.round(_c(qty) * _c(price), 2)
    cost = F.round(_c(qty) * _c(unit_cost), 2)
    return {
        "monto_bruto": gross,
        "monto_descuento": gross - _c(net),
        "costo_total": cost,
        "margen_bruto": _c(net) - cost,
    }


def safe_div(a, b, scale: int, factor: float | None = None, out_precision: int = 18) -> Column:
    """``round(a / nullif(b, 0) [* factor], scale)`` as a decimal.

    Division runs in double; the quotient is fixed to 8 decimals before the
    half-up rounding so both engines give the same digits.
    """
    num = _c(a).cast("double")
    den = F.nullif(_c(b).cast("double"), F.lit(0.0))
    q = num / den
    if factor is not None:
        q = q * F.lit(float(factor))
    return F.round(q.cast("decimal(24,8)"), scale).cast(f"decimal({out_precision},{scale})")


def pct(a, b, scale: int = 2) -> Column:
    """Percentage ``round(a / b * 100, scale)``."""
    return safe_div(a, b, scale, factor=100.0)


def growth_pct(cur, prev, scale: int = 2) -> Column:
    """``round((cur / prev - 1) * 100, scale)``; NULL when prev is NULL or 0."""
    q = _c(cur).cast("double") / F.nullif(_c(prev).cast("double"), F.lit(0.0))
    return F.round(((q - F.lit(1.0)) * F.lit(100.0)).cast("decimal(24,8)"), scale).cast(f"decimal(18,{scale})")


def avg_dec(c, scale: int) -> Column:
    """Average as exact sum / count, fixed to ``scale`` decimals (no order-dependent double sums)."""
    return safe_div(F.sum(_c(c)), F.count(_c(c)), scale)


def sum_dec(c, scale: int = 2) -> Column:
    return F.sum(_c(c)).cast(f"decimal(38,{scale})")


def sum_int(c) -> Column:
    return F.sum(_c(c)).cast("bigint")


def list_margin(price="precio_lista", cost="costo_base") -> Column:
    """``(price - cost) / price`` rounded to 4 when price > 0, else NULL."""
    return F.when(_c(price) > 0, safe_div(_c(price) - _c(cost), _c(price), 4, out_precision=7))


def valid_sale(status="estado_venta", valid_value: str = "COMPLETADA") -> Column:
    """``coalesce(status = 'COMPLETADA', false)``."""
    return F.coalesce(_c(status) == F.lit(valid_value), F.lit(False))


# Fixed labels of the stock status (B23), in priority order.
STOCK_OUT = "SIN STOCK"
STOCK_LOW = "BAJO MÍNIMO"
STOCK_OVER = "SOBRE STOCK"
STOCK_OK = "OK"


def stock_status(out="es_sin_stock", low="es_bajo_minimo", over="es_sobre_maximo") -> Column:
    return (
        F.when(_c(out), F.lit(STOCK_OUT))
        .when(_c(low), F.lit(STOCK_LOW))
        .when(_c(over), F.lit(STOCK_OVER))
        .otherwise(F.lit(STOCK_OK))
    )


# Fixed calendar names (B24): Spanish month and ISO weekday names.
MONTH_NAMES_ES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MONTH_NAMES_EN = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
DAY_NAMES_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _name_lookup(names: list[str], idx_1based: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx_1based)


def iso_weekday(c) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(c)) + 1).cast("int")


def month_name_es(c) -> Column:
    return _name_lookup(MONTH_NAMES_ES, F.month(_c(c)))


def day_name_es(c) -> Column:
    return _name_lookup(DAY_NAMES_ES, iso_weekday(c))


def month_name_en(c) -> Column:
    return _name_lookup(MONTH_NAMES_EN, F.month(_c(c)))


def day_name_en(c) -> Column:
    return _name_lookup(DAY_NAMES_EN, iso_weekday(c))


def year_month(c) -> Column:
    """'YYYY-MM'."""
    return F.date_format(_c(c), "yyyy-MM")


def calendar_parts(c) -> dict:
    """All calendar attributes of a date."""
    d = _c(c)
    return {
        "anio": F.year(d).cast("int"),
        "trimestre": F.quarter(d).cast("int"),
        "mes": F.month(d).cast("int"),
        "nombre_mes": month_name_es(d),
        "anio_mes": year_month(d),
        "semana_iso": F.weekofyear(d).cast("int"),
        "dia_mes": F.dayofmonth(d).cast("int"),
        "dia_semana_iso": iso_weekday(d),
        "nombre_dia": day_name_es(d),
        "es_fin_de_semana": iso_weekday(d).isin(6, 7),
    }


def months_back(c, n: int) -> Column:
    """``d - n months`` with end-of-month clamping."""
    return F.add_months(_c(c), -n)
