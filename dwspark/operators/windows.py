"""Window operators.

Every window here is partitioned by a data key, so the work spreads over the
cluster; un-partitioned windows are only applied to already aggregated frames
(one row per month, per category, ...), never to fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in ([cs] if isinstance(cs, (str, Column)) else cs)]


def top1_per_key(df: DataFrame, keys, order) -> DataFrame:
    """``row_number() = 1`` per key (F01); Spark plans a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def rank_flag(df: DataFrame, keys, order, out: str) -> DataFrame:
    """``rank() = 1`` as a flag, ties all flagged (F02). State NULL ordering in ``order``."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn(out, F.rank().over(w) == 1)


def is_min_per_key(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """``rank() OVER (PARTITION BY keys ORDER BY col ASC NULLS LAST) = 1`` without a window.

    The minimum per key is a partial (map-side) aggregate, so a key holding a
    large share of the rows is reduced before the shuffle instead of sorted in
    one task; the flag is then one equi-join back. Ties are all flagged; when
    every value of a key is NULL they all tie at rank 1.
    """
    m = df.groupBy(*keys).agg(F.min(col).alias("__min"))
    m = m.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__min")
    cond = None
    for i, k in enumerate(keys):  # NULL keys form one group, as in a window partition
        c = df[k].eqNullSafe(F.col(f"__k{i}"))
        cond = c if cond is None else cond & c
    j = df.join(m, cond, "left")
    flag = F.when(F.col("__min").isNull(), F.lit(True)).otherwise(F.coalesce(F.col(col) == F.col("__min"), F.lit(False)))
    return j.withColumn(out, flag).drop("__min", *[f"__k{i}" for i in range(len(keys))])


def dedup_first(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row per key in an explicit order.

    ``dropDuplicates`` keeps an arbitrary row; the order column (usually the
    source row number, A05) makes "first" deterministic.
    """
    return top1_per_key(df, keys, order)


def period_shift(df: DataFrame, keys: list[str], month_col: str, value: str, months: int, out: str) -> DataFrame:
    """Value of the same keys ``months`` calendar months earlier.

    A window over the month's number, exactly ``months`` back: the input is
    evaluated once, and a missing month gives NULL (unlike ``lag``, which would
    take whatever row came before). ``month_col`` holds the first day of the
    month, once for each of the ``keys``; without keys the rows are the months
    of an aggregate.
    """
    number = F.year(month_col) * 12 + F.month(month_col)
    back = Window.partitionBy(*keys).orderBy(number).rangeBetween(-months, -months)
    return df.withColumn(out, F.max(value).over(back))
