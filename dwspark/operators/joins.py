"""Join operators.

Broadcast policy: a side is broadcast only behind a size check
(``broadcast_bounded``); above the bound the join stays a shuffle join, and
AQE may still convert it at run time from measured stage sizes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.functions.intervals import cover, days_of, path

# Largest row count we are willing to ship to every executor. The sides checked
# against it are key columns or narrow dimensions of at most 128 bytes a row: 64 MB.
DEFAULT_BROADCAST_ROWS = 500_000


def row_bound_ok(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A count: each task sends one number, and no rows meet in a single task.
    Use it on frames that are cheap to evaluate (reference tables, incoming
    batches); for
    small frames derived from large inputs leave the decision to AQE, which
    converts the join to a broadcast from the measured shuffle size instead of
    evaluating the sub-plan twice.
    """
    return df.count() <= max_rows


def broadcast_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when the row count is proven within ``max_rows``; else no hint."""
    return F.broadcast(df) if row_bound_ok(df, max_rows) else df


def promotion_calendar(promos: DataFrame, key: str = "categoria", first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """One row per (key, day) covered by a promotion, with the winning promotion; days from ``first`` to ``last`` only.

    Winner: highest discount, then lowest id (D05). No promotion is expanded
    to its days: each gives the nodes of its dyadic cover, at most two a
    level, of which the best one of a (key, node) stays. Only these nodes are
    expanded, so the rows are bounded by keys, days and levels, however many
    promotions there are and however long they run.
    """
    start, end = F.col("fecha_inicio"), F.col("fecha_fin")
    start = F.greatest(start, F.lit(first)) if first else start
    end = F.least(end, F.lit(last)) if last else end
    # the larger is the better promotion
    rank = F.struct("porcentaje_descuento", (-F.col("id_promocion")).alias("less"), "id_promocion")
    nodes = promos.where(F.col("fecha_inicio").isNotNull() & F.col("fecha_fin").isNotNull()).select(key, rank.alias("rank"), F.explode(cover(start, end)).alias("n"))
    best = nodes.groupBy(key, "n").agg(F.max("rank").alias("rank"))
    days = best.select(key, "rank", F.explode(days_of("n.level", "n.node")).alias("fecha"))
    return days.groupBy(key, "fecha").agg(F.max("rank").alias("rank")).select(key, "fecha", F.col("rank.id_promocion").alias("id_promocion"))


def attribute_promotion(
    lines: DataFrame,
    promos: DataFrame,
    key: str = "categoria",
    date_col: str = "fecha_venta",
    max_calendar_rows: int = DEFAULT_BROADCAST_ROWS,
    days: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Range join "sale date within a promotion of the same category" (D05).

    Instead of joining every line with every overlapping promotion and ranking
    per line (a fact-sized shuffle and window), the winner of each (key, day)
    is found from the promotions' dyadic covers; the facts then take one
    equi-join on (key, day) against that calendar, broadcast when its size is
    proven small. ``days`` bounds the sale dates (the lines' own first and
    last day if not given), so a promotion without an end costs no more than
    one that ends with the sales. Lines without a promotion get NULL ``id_promocion``.
    """
    first, last = days or lines.agg(F.min(date_col), F.max(date_col)).first()
    cal = promotion_calendar(promos, key, first, last).withColumnRenamed("fecha", "__d").withColumnRenamed(key, "__k")
    # keys x days bounds the calendar, from a count of the promotions' keys alone
    keys = promos.select(key).distinct().count()
    small = first is None or keys * ((last - first).days + 1) <= max_calendar_rows
    cal = F.broadcast(cal) if small else cal
    j = lines.join(cal, (lines[key] == F.col("__k")) & (lines[date_col] == F.col("__d")), "left")
    return j.drop("__k", "__d")


def overlaps(df: DataFrame, key: str, start: str, end: str, id_col: str) -> DataFrame:
    """Pairs of date intervals with the same key that intersect.

    Emits (id_a, id_b, key, overlap_from, overlap_to) with id_a < id_b for
    every pair with ``a.start <= b.end and b.start <= a.end``.

    No pair that does not overlap is ever formed, and no interval is expanded
    to its days: of two overlapping intervals, the one starting later (ties:
    the higher id) starts on a day the other covers. So the dyadic cover of
    every interval is equi-joined on (key, node) with the nodes that hold the
    start day of the others, which meet in exactly one. The work is a few
    dozen rows an interval, whatever its length, plus the overlapping pairs,
    however many intervals share a key. The exact predicate is kept as a
    residual for reversed (start > end) intervals, which cover nothing.
    """
    covers = df.select(
        F.col(id_col).alias("a_id"), F.col(key).alias("k"), F.col(start).alias("a_s"), F.col(end).alias("a_e"),
        F.explode(cover(start, end)).alias("n"),
    )
    starts = df.select(F.col(id_col).alias("b_id"), F.col(key).alias("k"), F.col(start).alias("b_s"),
                       F.col(end).alias("b_e"), F.explode(path(start)).alias("n"))
    later = (F.col("a_s") < F.col("b_s")) | ((F.col("a_s") == F.col("b_s")) & (F.col("a_id") < F.col("b_id")))
    exact = (F.col("a_s") <= F.col("b_e")) & (F.col("b_s") <= F.col("a_e")) & (F.col("a_id") != F.col("b_id"))
    j = covers.join(starts, ["k", "n"]).filter(later & exact)
    return j.select(
        F.least("a_id", "b_id").alias(f"{id_col}_a"),
        F.greatest("a_id", "b_id").alias(f"{id_col}_b"),
        F.col("k").alias(key),
        F.greatest("a_s", "b_s").alias("traslape_desde"),
        F.least("a_e", "b_e").alias("traslape_hasta"),
    )


def enrich_returns(returns: DataFrame, lines: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """Returns joined with what was sold.

    Lines are first collapsed to (sale, product) - partial aggregation before
    the shuffle - so a product repeated in a sale cannot fan the return out.
    ``known`` names flags of the lines that tell whether the customer or branch
    exists; the flag of the one that is taken comes along.
    """
    known = known or {}
    # the least value with its flag: the least of those that have it set, against the least of the others
    least = [F.min(F.when(F.col(f), F.col(c))).alias(f"{f}_min") for c, f in known.items()] + [F.min(F.when(~F.col(f), F.col(c))).alias(f"{f}_not") for c, f in known.items()]
    sold = lines.groupBy("id_venta", "id_producto").agg(
        F.min("fecha_venta").alias("fecha_venta"),
        *[F.min(c).alias(c) for c in ("id_cliente", "id_sucursal") if c not in known],
        *least,
        F.sum("cantidad").cast("bigint").alias("cantidad_vendida"),
        F.sum("monto_neto").cast("decimal(38,2)").alias("monto_neto_vendido"),
    )
    j = returns.join(sold, ["id_venta", "id_producto"], "left")
    for c, f in known.items():
        yes, no = F.col(f"{f}_min"), F.col(f"{f}_not")
        j = j.withColumns({c: F.least(yes, no), f: yes.isNotNull() & (no.isNull() | (yes < no))})
    net = F.col("monto_neto_vendido").cast("double")
    qty = F.nullif(F.col("cantidad_vendida").cast("double"), F.lit(0.0))
    return j.select(
        "id_devolucion",
        "fecha_devolucion",
        "id_venta",
        "id_producto",
        "cantidad_devuelta",
        "motivo",
        "fecha_venta",
        "id_cliente",
        "id_sucursal",
        "cantidad_vendida",
        F.round((net / qty).cast("decimal(24,8)"), 4).cast("decimal(12,4)").alias("precio_neto_unitario"),
        F.round((F.col("cantidad_devuelta").cast("double") * net / qty).cast("decimal(24,8)"), 2)
        .cast("decimal(14,2)")
        .alias("monto_devuelto"),
        F.datediff("fecha_devolucion", "fecha_venta").alias("dias_desde_venta"),
        *known.values(),
    )
