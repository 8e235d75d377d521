"""Dyadic cover of day intervals, for interval joins that never expand an interval into its days.

Days are numbered from 0001-01-01. A node (level, index) is the run of 2^level
days from index * 2^level. Every interval is the disjoint union of at most two
nodes a level (``cover``), and a day lies in one node of each level (``path``),
so a day meets the cover of an interval in exactly one node if the interval
holds it and in none otherwise: an equi-join on (level, index), with no
residual.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_DAY = "0001-01-01"
LEVELS = 22  # 2^22 days reach beyond 9999-12-31


def day_number(c: Column | str) -> Column:
    return F.date_diff(F.col(c) if isinstance(c, str) else c, F.lit(FIRST_DAY).cast("date")).cast("int")


def _within(a: Column, b: Column, level: Column) -> tuple[Column, Column]:
    """First and last node of the level that lie within the days a..b; none if first > last."""
    width = F.pow(F.lit(2), level)
    return F.ceil(a / width).cast("int"), (F.floor((b + 1) / width) - 1).cast("int")


def cover(start: Column | str, end: Column | str) -> Column:
    """array<struct<level, node>> of the interval's nodes; empty if start > end or one is NULL."""
    a, b = day_number(start), day_number(end)

    def level_nodes(level: Column) -> Column:
        first, last = _within(a, b, level)
        up_first, up_last = _within(a, b, level + 1)

        def kept(node: Column) -> Column:
            """Within the interval, while the node that holds it isn't."""
            above = F.shiftright(node, 1)
            return (first <= last) & ~((up_first <= above) & (above <= up_last))

        node = lambda n: F.struct(level.alias("level"), n.alias("node"))
        return F.array_compact(F.array(F.when(kept(first), node(first)), F.when(kept(last) & (last != first), node(last))))

    nodes = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), level_nodes))
    return F.when(a <= b, nodes).otherwise(F.expr("cast(array() as array<struct<level:int,node:int>>)"))


def path(day: Column | str) -> Column:
    """array<struct<level, node>> of the nodes that hold the day."""
    d = day_number(day)
    nodes = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda level: F.struct(level.alias("level"), F.floor(d / F.pow(F.lit(2), level)).cast("int").alias("node")))
    return F.when(d.isNotNull(), nodes)


def days_of(level: Column | str, node: Column | str) -> Column:
    """array<date> of a node's days."""
    level, node = (F.col(c) if isinstance(c, str) else c for c in (level, node))
    width = F.pow(F.lit(2), level).cast("int")
    first = F.date_add(F.lit(FIRST_DAY).cast("date"), node * width)
    return F.sequence(first, F.date_add(first, width - 1))
