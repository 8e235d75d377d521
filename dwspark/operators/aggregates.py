"""Aggregation operators (E01-E14) that need more than ``groupBy().agg``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.functions.exprs import safe_div


def _pivot_values(df: DataFrame, column: str, values: list | None) -> list:
    if values is not None:
        return list(values)
    # the distinct pivot values: one small aggregate job (what pivot() does
    # itself), bounded like pivot() by spark.sql.pivotMaxValues
    cap = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = [r[0] for r in df.select(column).distinct().limit(cap + 1).collect()]
    if len(found) > cap:
        raise ValueError(f"pivot column {column!r} has more than {cap} distinct values; pass them explicitly")
    return sorted(found)


def pivot_mean(df: DataFrame, index: str, column: str, value: str, values: list | None = None, scale: int = 2) -> DataFrame:
    """Mean of ``value`` per index x column, absent cells 0, rounded.

    Rows with NULL index or column are dropped (as a pivot table does); NULL
    values are ignored by the mean. The mean is an exact sum / count per cell
    (conditional aggregation, one pass); pass ``values`` to skip the job that
    discovers the pivot columns.
    """
    src = df.filter(F.col(index).isNotNull() & F.col(column).isNotNull())
    vals = _pivot_values(src, column, values)
    aggs = []
    for i, v in enumerate(vals):
        hit = F.col(column) == F.lit(v)
        aggs += [F.sum(F.when(hit, F.col(value))).alias(f"__s{i}"), F.count(F.when(hit, F.col(value))).alias(f"__n{i}")]
    g = src.groupBy(index).agg(*aggs)
    return g.select(
        index,
        *[F.coalesce(safe_div(f"__s{i}", f"__n{i}", scale), F.lit(0).cast(f"decimal(18,{scale})")).alias(str(v))
          for i, v in enumerate(vals)],
    )


def pivot_count(df: DataFrame, index: str, column: str, count_col: str, values: list | None = None) -> DataFrame:
    """Count of non-NULL ``count_col`` per index x column, absent cells 0."""
    src = df.filter(F.col(index).isNotNull() & F.col(column).isNotNull())
    vals = _pivot_values(src, column, values)
    return src.groupBy(index).agg(
        *[F.count(F.when(F.col(column) == F.lit(v), F.col(count_col))).alias(str(v)) for v in vals]
    )


def value_counts(df: DataFrame, col: str, scale: int = 4) -> DataFrame:
    """Count per value and share of the total (E10). The total is a scalar subquery."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("cantidad"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("proporcion", safe_div(F.col("cantidad"), total, scale))
