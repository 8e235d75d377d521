"""Slowly changing dimension type 2 (H16) on plain files: load by load (``scd2_apply``), or all loads at once (``scd2_history``).

Semantics of a load:
* key without a current version -> insert a version starting ``as_of``;
* tracked attribute changed (NULL-safe) -> close the current version
  (end = ``as_of``, not current) and insert a new one;
* unchanged, or key absent from the batch -> keep as is;
* the same batch applied twice changes nothing;
* a change on the very day a version started replaces that version: a key has
  one version a day;
* a batch dated before the start of a current version that it would change is
  an error (``as_of`` must not go back).

All steps are joins on the natural key (hash-partitioned by it), so the work
spreads over the cluster; the input batch must hold one row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.functions.keys import sk

START, END, CURRENT = "fecha_inicio_vigencia", "fecha_fin_vigencia", "es_actual"


def scd2_apply(
    current: DataFrame | None,
    incoming: DataFrame,
    key: str,
    tracked: list[str],
    as_of: str,
    sk_col: str = "sk",
) -> DataFrame:
    """Return the new full history for ``incoming`` applied to ``current`` at ``as_of``."""
    as_of_d = F.lit(as_of).cast("date")
    attrs = [c for c in incoming.columns if c != key]

    def version(df: DataFrame) -> DataFrame:
        return df.select(
            sk(key, as_of_d).alias(sk_col), key, *attrs,
            as_of_d.alias(START), F.lit(None).cast("date").alias(END), F.lit(True).alias(CURRENT),
        )

    if current is None:
        return version(incoming)

    cols = current.columns
    hist = current.filter(~F.col(CURRENT))
    cur = current.filter(F.col(CURRENT))
    cur_t = cur.select(F.col(key).alias("__k"), *[F.col(t).alias(f"__c_{t}") for t in tracked])
    cmp = incoming.join(cur_t, incoming[key] == F.col("__k"), "left")
    same = reduce(lambda a, b: a & b, [F.col(t).eqNullSafe(F.col(f"__c_{t}")) for t in tracked])
    changed = cmp.filter(F.col("__k").isNull() | ~same).select(*incoming.columns)
    changed_keys = changed.select(key)
    back = F.raise_error(F.concat(F.lit(f"load of {as_of} goes back before the version of "), F.col(START).cast("string"))).cast("date")
    # the date comes from the joined side, so that the check runs on changed keys only, after the join
    dated = changed_keys.withColumn("__as_of", F.when(F.col(key).isNotNull(), as_of_d))
    ended = cur.join(dated, key).withColumn(END, F.when(F.col(START) > F.col("__as_of"), back).otherwise(F.col("__as_of")))
    closed = ended.filter(F.col(END) > F.col(START)).withColumn(CURRENT, F.lit(False)).select(cols)
    kept = cur.join(changed_keys, key, "left_anti").select(cols)
    return hist.select(cols).unionByName(kept).unionByName(closed).unionByName(version(changed).select(cols))


def scd2_history(loads: DataFrame, key: str, tracked: list[str], as_of: str = "as_of", sk_col: str = "sk") -> DataFrame:
    """The whole history of many loads in one pass, whatever order they arrived in.

    ``loads`` holds every load's rows with its date in ``as_of``, one row a key and
    date. A version is an island: consecutive loads of a key whose tracked
    attributes are equal (NULL-safe). It takes its attributes from its first
    load and ends where the next one starts. The result is that of
    ``scd2_apply`` load by load in date order; a late load is one more row
    here, and the history is derived again. A key has as many rows as there were
    loads of it, so no window is larger than that.
    """
    by_date = Window.partitionBy(key).orderBy(as_of)
    attrs = [c for c in loads.columns if c not in (key, as_of)]
    before = F.lag(F.struct(*tracked)).over(by_date)
    starts = loads.select("*", F.row_number().over(by_date).alias("__n"), before.alias("__before"))
    starts = starts.where((F.col("__n") == 1) | ~F.struct(*tracked).eqNullSafe(F.col("__before")))
    end = F.lead(as_of).over(by_date)
    return starts.select(
        sk(key, F.col(as_of)).alias(sk_col), key, *attrs, F.col(as_of).alias(START), end.alias(END), end.isNull().alias(CURRENT),
    )
