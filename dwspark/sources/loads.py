"""Loads, lineage and audit.

Plain parquet has no transactions or MERGE, so every load of a single table
writes a NEW version directory and then publishes it as a new numbered pointer
file under ``_current``, created in one step; readers take the highest number.
Nothing that is read is ever overwritten, a failed load leaves the previous
version in place, and an unreadable pointer is an error, never an empty table.
Upserts are anti-join + union, not row-by-row statements. Tables that are
published together or merged by bucket live in a ``store.Store``; loads that are
logged and counted are in ``audit``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.operators.joins import DEFAULT_BROADCAST_ROWS, row_bound_ok
from dwspark.operators.windows import dedup_first
from dwspark.session import freed_shuffles
from dwspark.sources.store import CODEC, SINGLE, Conflict, Store, create_once, file_system, read_text

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
ERROR_TEXT_LIMIT = 4000
POINTER = "_current"


# ----------------------------------------------------------- versioned tables
def write_version(df: DataFrame, root: str, version: str | None = None, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version of the table at ``root`` and point readers to it."""
    spark = df.sparkSession
    version = version or uuid.uuid4().hex[:12]
    path = f"{root.rstrip('/')}/v={version}"
    w = df.write.mode("errorifexists").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(spark):
        w.parquet(path)
    publish(spark, root, version)
    return path


def _pointers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the pointers, ascending; none when the table was never written. Other errors are raised."""
    fs, folder = file_system(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(folder):
        return []
    found = [(st.getPath().getName(), st.isFile()) for st in fs.listStatus(folder)]
    return sorted(int(n) for n, is_file in found if is_file and n.isdigit())


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Point readers to ``version``: a new pointer, created in one step; a number that another load took meanwhile is an error."""
    number = (_pointers(spark, root) or [0])[-1] + 1
    if not create_once(spark, f"{root.rstrip('/')}/{POINTER}/{number:012d}", version):
        raise Conflict(f"{root}: another load published at the same time")


def current_version(spark: SparkSession, root: str) -> str | None:
    """The published version (of a single keyed table: the store's newest state); None only if nothing was ever published."""
    numbers = _pointers(spark, root)
    if numbers:
        return read_text(spark, f"{root.rstrip('/')}/{POINTER}/{numbers[-1]:012d}")
    states = Store(spark, root).numbers()
    return f"state-{states[-1]}" if states else None


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete published versions older than the newest ``keep`` (at least 1) and their pointers; returns how many went.

    Keep more than one while readers may still hold the previous version.
    """
    numbers = _pointers(spark, root)[: -max(1, keep)]
    live = {read_text(spark, f"{root.rstrip('/')}/{POINTER}/{n:012d}") for n in _pointers(spark, root)[-max(1, keep):]}
    for n in numbers:
        pointer = f"{root.rstrip('/')}/{POINTER}/{n:012d}"
        version = read_text(spark, pointer)
        for path in ([] if version in live else [f"{root.rstrip('/')}/v={version}"]) + [pointer]:
            fs, p = file_system(spark, path)
            fs.delete(p, True)
    return len(numbers)


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``root``: its published version, or the one keyed table that a store there holds."""
    v = current_version(spark, root)
    if v is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return Store(spark, root).read(SINGLE) if v.startswith("state-") else spark.read.parquet(f"{root.rstrip('/')}/v={v}")


def full_load(df: DataFrame, root: str, version: str | None = None) -> str:
    """Replace the table (A09): idempotent - loading the same input twice gives the same table."""
    return write_version(df, root, version)


def merge_rows(target: DataFrame | None, incoming: DataFrame, key: list[str] | str,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Upsert by key (A10): target rows whose key is in the batch are replaced; others kept.

    Source deletes are not propagated. The incoming batch must hold one row
    per key (use ``dedup_first`` otherwise). When the batch's keys are proven
    within ``max_broadcast_rows`` (a count of the batch) they are
    broadcast, and the target is filtered map-side: an incremental load then
    never shuffles the target. Larger batches take a shuffle anti-join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if target is None:
        return incoming
    batch_keys = incoming.select(*keys)
    if row_bound_ok(batch_keys, max_broadcast_rows):
        batch_keys = F.broadcast(batch_keys)
    kept = target.join(batch_keys, keys, "left_anti")
    return kept.unionByName(incoming)


def merge_load(spark: SparkSession, root: str, incoming: DataFrame, key, version: str | None = None) -> str:
    """A10 on a versioned table: read current, merge, write a new version."""
    cur = read_current(spark, root)
    return write_version(merge_rows(cur, incoming, key), root, version)


def stamp(df: DataFrame, batch_id: str, source: str, loaded_at: Column | None = None) -> DataFrame:
    """Lineage columns ``_batch_id``, ``_source``, ``_loaded_at``."""
    return df.withColumns({
        "_batch_id": F.lit(batch_id),
        "_source": F.lit(source),
        "_loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(),
    })


# ------------------------------------------------------------------ watermarks
WATERMARK_SCHEMA = "source_name string, watermark_col string, last_value string, updated_at timestamp"


def get_watermark(wm: DataFrame, source: str) -> Column:
    """The stored high-water mark of ``source`` as a scalar (NULL when none)."""
    return wm.filter(F.col("source_name") == source).agg(F.max("last_value")).scalar()


def advance_watermark(wm: DataFrame, source: str, col: str, extracted: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """New watermark = max(col) of the EXTRACTED rows; unchanged when the batch is empty."""
    dtype = extracted.schema[col].dataType
    mx = F.max(col)
    # timestamps are stored with a fixed microsecond format, so the text compares and parses back exactly
    text = F.date_format(mx, "yyyy-MM-dd HH:mm:ss.SSSSSS") if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else mx.cast("string")
    new = extracted.agg(text.alias("last_value")).filter(F.col("last_value").isNotNull())
    new = new.select(
        F.lit(source).alias("source_name"), F.lit(col).alias("watermark_col"), "last_value",
        (updated_at if updated_at is not None else F.current_timestamp()).cast("timestamp").alias("updated_at"),
    )
    return merge_rows(wm, new, "source_name")


# -------------------------------------------------------------- reconciliation
def reconcile(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """Source vs target row counts, one row (A13); each count is its own aggregate."""
    return source.agg(F.count(F.lit(1)).alias("filas_origen")).select(
        F.lit(name).alias("tabla"), "filas_origen", target.agg(F.count(F.lit(1))).scalar().alias("filas_destino")
    ).withColumn("cuadra", F.col("filas_origen") == F.col("filas_destino"))


# --------------------------------------------------------------------- audit
LOAD_LOG_SCHEMA = (
    "batch_id string, source_name string, target_table string, load_mode string, rows_extracted bigint, "
    "rows_loaded bigint, event_at timestamp, status string, error_message string"
)


def load_event(spark: SparkSession, batch_id: str, source: str, target: str, mode: str, status: str,
               rows_extracted=None, rows_loaded=None, error: str | None = None, at: str | None = None) -> DataFrame:
    """One load-log event (A14); the error text is capped at 4,000 characters."""
    row = [(batch_id, source, target, mode, rows_extracted, rows_loaded, None, status,
            error[:ERROR_TEXT_LIMIT] if error else None)]
    df = spark.createDataFrame(row, LOAD_LOG_SCHEMA)
    return df.withColumn("event_at", F.lit(at).cast("timestamp") if at else F.current_timestamp())


def load_log_latest(events: DataFrame) -> DataFrame:
    """Latest state per (batch, source) of the append-only log (A14); at the same time an end beats its start."""
    w = Window.partitionBy("batch_id", "source_name").orderBy(F.col("event_at").desc(), F.col("status") == RUNNING)
    return events.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def run_summary(load_log: DataFrame, checks: DataFrame, batch_id: str) -> DataFrame:
    """One row per batch (A15): FAILED if a load failed, an error check failed, or no check ran."""
    loads = load_log_latest(load_log.filter(F.col("batch_id") == batch_id)).agg(
        F.count_if(F.col("status") == SUCCESS).alias("loads_ok"), F.count_if(F.col("status") == FAILED).alias("loads_failed"))
    c = checks.agg(
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "error")).alias("checks_failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "warn")).alias("checks_warned"),
        F.count(F.lit(1)).alias("checks_run"),
    )
    failed = (F.col("loads_failed") > 0) | (F.col("checks_failed") > 0) | (F.col("checks_run") == 0)
    return loads.select(
        F.lit(batch_id).alias("batch_id"), "loads_ok", "loads_failed",
        c.select("checks_passed").scalar().alias("checks_passed"),
        c.select("checks_failed").scalar().alias("checks_failed"),
        c.select("checks_warned").scalar().alias("checks_warned"),
        c.select("checks_run").scalar().alias("checks_run"),
    ).withColumn("status", F.when(failed, F.lit(FAILED)).otherwise(F.lit(SUCCESS)))


# ------------------------------------------------------------------- contracts
class ContractViolation(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exact columns, order and types of a declared contract (A18): cast, never coerce silently.

    Casts run under ANSI (a bad value raises), and so does a NULL in a NOT
    NULL field, in the row that holds it: no extra pass. ``contract_violations``
    counts such rows beforehand.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ContractViolation(f"missing columns: {missing}")

    def field(f: T.StructField) -> Column:
        c = F.col(f.name).cast(f.dataType)
        if f.nullable:
            return c.alias(f.name)
        error = F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType)
        return F.when(c.isNull(), error).otherwise(c).alias(f.name)

    return df.select(*[field(f) for f in schema.fields])


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULL counts of every NOT NULL field, one aggregate pass; rows only where count > 0."""
    req = [f.name for f in schema.fields if not f.nullable]
    if not req:
        return df.sparkSession.createDataFrame([], "columna string, nulos bigint")
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in req])
    stacked = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("nulos")) for c in req])).alias("r"))
    return stacked.select("r.*").filter("nulos > 0")


def freshness(df: DataFrame, ts_col: str, now, warn_hours: float = 24, error_hours: float = 48) -> DataFrame:
    """Age of the newest row vs thresholds (A19): pass / warn / error."""
    now_c = F.lit(now).cast("timestamp")
    agg = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (F.unix_timestamp(now_c) - F.unix_timestamp("max_loaded_at")) / F.lit(3600.0)
    age_dec = F.round(age.cast("decimal(24,8)"), 2).cast("decimal(18,2)")
    return agg.select(
        "max_loaded_at", age_dec.alias("horas"),
        F.when(F.col("max_loaded_at").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("estado"),
    )


def insert_missing(dim: DataFrame | None, incoming: DataFrame, key: list[str] | str, order: list) -> DataFrame:
    """Insert-if-missing by natural key; first occurrence in ``order`` wins."""
    keys = [key] if isinstance(key, str) else list(key)
    first = dedup_first(incoming, keys, order)
    if dim is None:
        return first.select(*incoming.columns)
    new = first.join(dim.select(*keys), keys, "left_anti")
    return dim.unionByName(new.select(*dim.columns))


# ---------------------------------------------------------- defect injection
def inject_defect(df: DataFrame, case_no: int, order_cols: list[str], key_col: str | None, field: str, value,
                  case_type: str, fixed: dict | None = None) -> DataFrame:
    """One defect case (A17): the n-th row in ``order_cols`` order as template, new key 990000+n,
    one field overridden (''/None -> NULL), tagged ``_source = 'quality_case:<type>'``.

    Top-k, not a full sort: ``orderBy().limit(n+1)`` keeps only n+1 rows per task.
    Rows earlier injected (``_source`` starting with 'quality_case') are not templates.
    """
    src = df
    if "_source" in df.columns:
        src = df.filter(~F.coalesce(F.col("_source").startswith("quality_case"), F.lit(False)))
    tmpl = src.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(case_no + 1)
    tmpl = tmpl.withColumn("__rn", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])))
    row = tmpl.filter(F.col("__rn") == case_no + 1).drop("__rn")
    dtype = dict(row.dtypes)[field]
    new_val = F.lit(None).cast(dtype) if value in (None, "") else F.lit(value).cast(dtype)
    row = row.withColumn(field, new_val)
    if key_col:
        row = row.withColumn(key_col, F.lit(990000 + case_no).cast(dict(row.dtypes)[key_col]))
    for c, v in (fixed or {}).items():
        row = row.withColumn(c, F.lit(v).cast(dict(row.dtypes)[c]))
    row = row.withColumn("_source", F.lit(f"quality_case:{case_type}"))
    base = df if "_source" in df.columns else df.withColumn("_source", F.lit(None).cast("string"))
    return base.unionByName(row)
