"""Incremental loads on the ``events`` table and the load-layer operators as queries.

Two deliveries of ``events``: the first holds everything before ``CUT``; the
second re-delivers the last ``LOOKBACK_DAYS`` before ``CUT`` and everything
after, with changed values (a late correction). Re-delivered keys must
replace their older version; nothing is duplicated; re-running adds nothing.
Files written by these queries go under the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.functions.keys import sk
from dwspark.plans.warehouse import Warehouse
from dwspark.session import scratch_path
from dwspark.sources import audit as A
from dwspark.sources import ingest as I
from dwspark.sources import loads as L
from dwspark.sources.store import Store
from dwspark.streaming.upsert import stream_upsert

# Fixed parameters of the incremental scenario.
CUT = "2024-01-21 00:00:00"
LOOKBACK_DAYS = 2
VALUE_CORRECTION = 1000.0
SOURCE = "events"
FRESHNESS_LAG_HOURS = 30


class Incremental:
    def __init__(self, w: Warehouse):
        self.w = w
        self.spark = w.spark
        self.events = w.tables.events

    def batch1(self) -> DataFrame:
        return self.events.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))

    def watermark1(self):
        """High-water mark after the first load: max(ts) of the rows it extracted."""
        return self.batch1().agg(F.max("ts")).scalar()

    def batch2(self) -> DataFrame:
        """Second extraction: rows since watermark - lookback (A02), corrected values."""
        since = I.extract_since(self.events, "ts", self.watermark1(), LOOKBACK_DAYS)
        return since.withColumn("value", F.col("value") + F.lit(VALUE_CORRECTION))


def a02_extract_since(x: Incremental) -> DataFrame:
    return I.extract_since(x.events, "ts", x.watermark1(), LOOKBACK_DAYS)


def a03_extract_child_since(x: Incremental) -> DataFrame:
    """Sale lines (no date of their own) of sales since 2001-01-01, through the parent."""
    w = x.w
    return I.extract_child_since(w.stg_venta_detalle, w.stg_venta, "id_venta", "fecha_venta", "2001-01-01")


def a10_merge_load(x: Incremental) -> DataFrame:
    """The second delivery merged into the first: only the buckets its keys fall in are written anew (A10)."""
    store = Store(x.spark, scratch_path(x.spark, "a10"))
    base = store.snapshot()
    base = store.commit({SOURCE: store.keyed(SOURCE, x.batch1(), "event_id")}, base)
    store.commit({SOURCE: store.merge(SOURCE, x.batch2(), "event_id", at=base)}, base)
    return store.read(SOURCE)


def a12_watermark(x: Incremental) -> DataFrame:
    """Watermark table after both loads (first from batch 1, then advanced by batch 2)."""
    empty = x.spark.createDataFrame([], L.WATERMARK_SCHEMA)
    wm = L.advance_watermark(empty, SOURCE, "ts", x.batch1(), updated_at=F.lit(None))
    since = I.extract_since(x.events, "ts", L.get_watermark(wm, SOURCE).cast("timestamp_ntz"), LOOKBACK_DAYS)
    wm = L.advance_watermark(wm, SOURCE, "ts", since, updated_at=F.lit(None))
    return wm.select("source_name", "watermark_col", "last_value")


def a13_reconcile(x: Incremental) -> DataFrame:
    """Source lines vs the lines read back from a load of them."""
    root = scratch_path(x.spark, "a13_linea")
    L.full_load(x.w.fx.linea(), root)
    return L.reconcile(x.w.fx.linea(), L.read_current(x.spark, root), "venta_detalle")


def a09_full_load(x: Incremental) -> DataFrame:
    """Full load twice into a versioned table; the read-back equals the source (A09, idempotent)."""
    root = scratch_path(x.spark, "a09_cliente")
    src = x.w.stg_cliente
    L.full_load(src, root)
    L.full_load(src, root)
    return L.read_current(x.spark, root)


def a04_csv_contract(x: Incremental) -> DataFrame:
    """Customers exported as CSV and read back with header contract, row numbers and blank->NULL."""
    root = scratch_path(x.spark, "a04_csv")
    cols = x.w.stg_cliente.columns
    I.write_csv(x.w.stg_cliente, root)
    return I.read_csv_numbered(x.spark, root, cols).drop("_row_number")


def a07_csv_positional(x: Incremental) -> DataFrame:
    """Parts exported as CSV and read back with names given by position."""
    root = scratch_path(x.spark, "a07_csv")
    I.write_csv(x.w.tables.part.select("p_partkey", "p_name", "p_brand"), root)
    return I.read_csv_positional(x.spark, root, ["codigo", "nombre", "marca"])


def a08_csv_infer(x: Incremental) -> DataFrame:
    """Parts exported as CSV and read back with inferred types, which are part of the result."""
    root = scratch_path(x.spark, "a08_csv")
    I.write_csv(x.w.tables.part.select("p_partkey", "p_size", "p_name"), root)
    out = I.read_csv_infer(x.spark, root)
    types = ",".join(t for _, t in out.dtypes)
    return out.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), F.col("p_size").cast("bigint").alias("p_size"), "p_name", F.lit(types).alias("tipos"))


def a11_stamp(x: Incremental) -> DataFrame:
    """Customers as a tracked load leaves them, with batch and source."""
    store = Store(x.spark, scratch_path(x.spark, "a11"))
    A.tracked_load(store, "lote-1", "cliente", x.w.stg_cliente)
    return store.read("cliente").filter(F.col("_loaded_at").isNotNull()).select("id_cliente", "_batch_id", "_source")


def a18_conform_dim_sucursal(x: Incremental) -> DataFrame:
    contract = T.StructType([
        T.StructField("sk_sucursal", T.StringType(), False),
        T.StructField("id_sucursal", T.LongType(), False),
        T.StructField("nombre_sucursal", T.StringType(), False),
        T.StructField("ciudad", T.StringType(), True),
        T.StructField("departamento", T.StringType(), True),
    ])
    return L.conform(x.w.dim_sucursal, contract)


def a19_freshness(x: Incremental) -> DataFrame:
    """Freshness of the events table at 'now' = newest event + 30 h -> warn."""
    now = x.events.agg(F.max("ts") + F.expr(f"INTERVAL {FRESHNESS_LAG_HOURS} HOURS")).scalar()
    return L.freshness(x.events, "ts", now)


def a20_insert_missing(x: Incremental) -> DataFrame:
    """Airline dimension loaded in two runs, insert-if-missing; first occurrence wins."""
    from dwspark.plans.flights import flights_of

    c = flights_of(x.w).clean.select("cod_aerolinea", "nom_aerolinea", "salida_dt", "id_vuelo")
    first = c.filter(F.to_date("salida_dt") <= F.lit("1998-12-31").cast("date"))
    d1 = L.insert_missing(None, first, "cod_aerolinea", ["salida_dt", "id_vuelo"]).select("cod_aerolinea", "nom_aerolinea")
    d2 = L.insert_missing(d1, c.select("cod_aerolinea", "nom_aerolinea", "salida_dt", "id_vuelo"), "cod_aerolinea",
                          ["salida_dt", "id_vuelo"])
    return d2.select(sk("cod_aerolinea").alias("id_aerolinea"), "cod_aerolinea", "nom_aerolinea")


def k01_stream_upsert(x: Incremental) -> DataFrame:
    """The two deliveries through the streaming upsert, then a re-run with no new input.

    End state must equal ``a10_merge_load``.
    """
    base = scratch_path(x.spark, "k01")
    src, target, ckpt = f"{base}/source", f"{base}/target", f"{base}/checkpoint"
    schema = x.events.schema
    x.batch1().write.mode("append").parquet(src)
    stream_upsert(x.spark, src, schema, target, "event_id", ckpt, order=["ts"])
    x.batch2().write.mode("append").parquet(src)
    stream_upsert(x.spark, src, schema, target, "event_id", ckpt, order=["ts"])
    stream_upsert(x.spark, src, schema, target, "event_id", ckpt, order=["ts"])  # nothing new: no change
    return L.read_current(x.spark, target)


def incremental_of(w: Warehouse) -> Incremental:
    x = getattr(w, "_incremental", None)
    if x is None:
        x = w._incremental = Incremental(w)
    return x


def queries() -> dict:
    fns = [a02_extract_since, a03_extract_child_since, a10_merge_load, a12_watermark, a13_reconcile, a09_full_load,
           a04_csv_contract, a07_csv_positional, a08_csv_infer, a11_stamp, a18_conform_dim_sucursal, a19_freshness, a20_insert_missing, k01_stream_upsert]
    return {f.__name__: f for f in fns}
