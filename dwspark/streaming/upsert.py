"""Incremental upsert as a Structured Streaming job.

``readStream`` over a directory of parquet batches -> ``foreachBatch`` that
merges each micro-batch into a keyed table of a ``Store`` (A10): only the
buckets that the batch's keys fall in are written anew, so a stream's work
follows its input, not the size of its target. ``trigger(availableNow=True)``
processes everything present and stops; the checkpoint records which files
were consumed, so a re-run adds nothing, and a crash between the data write
and the checkpoint commit replays the batch - harmless, because the merge
of the same batch is idempotent (same keys replaced by the same rows).

Within a micro-batch a key may arrive several times: the latest row by the
``order`` columns wins, and of rows that tie there, the one delivered last
(modification time, then name of its file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.sources.store import DEFAULT_BUCKETS, SINGLE, Store


def _latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def stream_upsert(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target_root: str,
    key: list[str] | str,
    checkpoint: str,
    order: list[str] | None = None,
    max_files_per_trigger: int | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> None:
    """Run the upsert stream until the available input is consumed; ``loads.read_current`` reads the result."""
    store = Store(spark, target_root)
    keys = [key] if isinstance(key, str) else list(key)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    delivered = ["__delivered", "__file"]
    src = reader.parquet(source_dir).select("*", F.col("_metadata.file_modification_time").alias(delivered[0]), F.col("_metadata.file_path").alias(delivered[1]))

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        inc = (_latest_per_key(batch, keys, [*order, *delivered]) if order else batch).drop(*delivered)
        base = store.snapshot()
        store.commit({SINGLE: store.merge(SINGLE, inc, keys, buckets, at=base)}, base)
        store.expire(keep=3)

    q = (
        src.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
