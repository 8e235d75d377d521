"""Tables published together as one snapshot.

A store is a folder of data directories, which are never changed once
written, and of numbered manifests. A manifest names, for every table, the
directory of each of its parts; the newest manifest is the store's state. So
readers see one state of all tables, a load that fails leaves nothing behind
but files that no manifest names, and publishing many tables is the
creation of one file.

What a part is depends on the table:

- ``full``: the table is one part, replaced by each load;
- ``keyed``: rows are dealt into a fixed number of buckets by a hash of their
  key. A merge rewrites only the buckets that its keys fall in; the manifest
  goes on naming the directories of all others;
- ``append``: one part for each batch id. A batch that is written again
  replaces its own part.

Manifests are created by a step that fails if the number is taken (see
``create_once``), which is the compare-and-swap of publishing: of two
publishers that started from one state the second takes the next number if
they changed different parts, and gets ``Conflict`` if they changed the same.

The driver holds one short path for each part, at most buckets or batches.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.session import freed_shuffles

FULL, KEYED, APPEND = "full", "keyed", "append"
MANIFESTS, BUCKET = "_manifests", "__bucket"
SINGLE = "rows"  # the table of a store that holds but one
DEFAULT_BUCKETS = 64
PUBLISH_ATTEMPTS = 20
CODEC = "zstd"  # keys are md5 in hex, of which it leaves half


class Conflict(RuntimeError):
    """Another load published a change of the same part since this one read the store."""


# ------------------------------------------------------------------------- files
def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path, so that any store Spark reads will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` as one step; False if the path exists.

    The text is written under another name first, so no reader sees half of
    it. On a local disk a hard link takes the name, elsewhere a rename that
    doesn't overwrite; both fail if another writer was faster. A store whose
    rename isn't atomic needs a lock of its own around ``Store.commit``.
    """
    jvm = spark._jvm
    fs, target = file_system(spark, path)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            paths = jvm.java.nio.file.Paths
            link, existing = (paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)) for p in (target, draft))
            jvm.java.nio.file.Files.createLink(link, existing)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(draft, target, options)
    except Exception as e:  # noqa: BLE001 - told apart by the JVM's class
        if "AlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# ------------------------------------------------------------------------ states
@dataclass(frozen=True)
class Table:
    """What a manifest says of one table: the directory of each part, relative to the store."""

    kind: str
    schema: str
    parts: dict[str, str]
    key: tuple[str, ...] = ()
    buckets: int = 0
    partition_by: tuple[str, ...] = ()
    counts: dict[str, Any] = field(default_factory=dict, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "schema", json.dumps(json.loads(self.schema), sort_keys=True))

    def as_dict(self) -> dict:
        return {"kind": self.kind, "schema": json.loads(self.schema), "parts": self.parts, "key": self.key, "buckets": self.buckets, "partition_by": self.partition_by}

    @staticmethod
    def of(d: dict) -> "Table":
        return Table(d["kind"], json.dumps(d["schema"]), d["parts"], tuple(d["key"]), d["buckets"], tuple(d["partition_by"]))

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Snapshot:
    number: int
    tables: dict[str, Table]


class Store:
    """Tables under ``root``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------------- reading
    def numbers(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.root}/{MANIFESTS}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest state, or that of ``number``; a store that was never written has none of its tables."""
        if number is None:
            number = (self.numbers() or [0])[-1]
        if number == 0:
            return Snapshot(0, {})
        found = json.loads(read_text(self.spark, f"{self.root}/{MANIFESTS}/{number:012d}"))
        return Snapshot(number, {n: Table.of(t) for n, t in found["tables"].items()})

    def read(self, name: str, at: Snapshot | None = None) -> DataFrame | None:
        """The table in the newest state or in ``at``; None if it was never written."""
        table = (at or self.snapshot()).tables.get(name)
        return None if table is None else self.frame(table)

    def frame(self, table: Table, only: list[str] | None = None) -> DataFrame:
        """The table's rows, or those of some of its parts."""
        paths = [f"{self.root}/{p}" for k, p in table.parts.items() if only is None or k in only]
        if not paths:
            return self.spark.createDataFrame([], table.struct)
        return self.spark.read.schema(table.struct).parquet(*paths)

    # ------------------------------------------------------------------- writing
    def _write(self, df: DataFrame, name: str, partition_by: list[str], watermark: str | None = None, batch: Column | None = None, also: dict[str, Column] | None = None) -> tuple[str, dict]:
        """Write ``df`` once; its rows, greatest ``watermark``, rows of the ``batch`` and ``also`` are counted by the write itself.

        They are observed in the stage that writes, where a task that is run
        again counts once.
        """
        folder = f"{name}/{uuid.uuid4().hex[:16]}"
        counted = [F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in (also or {}).items())]
        if watermark:
            counted.append(F.max(watermark).cast("string").alias("watermark"))
        if batch is not None:
            counted.append(F.count_if(batch).alias("batch_rows"))
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        with freed_shuffles(self.spark):
            df.observe(seen, *counted).write.mode("errorifexists").option("compression", CODEC).partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
        return folder, seen.get

    def full(self, name: str, df: DataFrame, partition_by: list[str] | None = None, watermark: str | None = None, also: dict[str, Column] | None = None) -> Table:
        """A new whole of the table, written but not published; the aggregates ``also`` are counted by the write."""
        partition_by = list(partition_by or [])
        folder, counts = self._write(df, name, partition_by, watermark, also=also)
        fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        return Table(FULL, T.StructType(fields).json(), {"": folder}, partition_by=tuple(partition_by), counts=counts)

    def discard(self, table: Table) -> None:
        """Delete the files of a table that was written but will not be published."""
        for path in table.parts.values():
            fs, p = file_system(self.spark, f"{self.root}/{path}")
            fs.delete(p, True)

    def append(self, name: str, df: DataFrame, batch_id: str, at: Snapshot | None = None) -> Table:
        """The table with ``df`` as the part of ``batch_id``, written but not published."""
        before = (at or self.snapshot()).tables.get(name)
        if before is not None:
            df = df.select(*before.struct.names)
        folder, counts = self._write(df, name, [])
        parts = {**(before.parts if before else {}), batch_id: folder}
        return Table(APPEND, before.schema if before else df.schema.json(), parts, counts=counts)

    @staticmethod
    def bucket_of(key: tuple[str, ...], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def keyed(self, name: str, df: DataFrame, key: list[str] | str, buckets: int = DEFAULT_BUCKETS, watermark: str | None = None) -> Table:
        """A new whole of a table in buckets by key, written but not published; ``df`` has one row a key."""
        keys = (key,) if isinstance(key, str) else tuple(key)
        dealt = df.withColumn(BUCKET, self.bucket_of(keys, buckets)).repartition(BUCKET)
        folder, counts = self._write(dealt, name, [BUCKET], watermark)
        return Table(KEYED, df.schema.json(), self._bucket_parts(folder), keys, buckets, counts=counts)

    def _bucket_parts(self, folder: str) -> dict[str, str]:
        fs, p = file_system(self.spark, f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return {n.partition("=")[2]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def merge(self, name: str, incoming: DataFrame, key: list[str] | str, buckets: int = DEFAULT_BUCKETS, watermark: str | None = None, at: Snapshot | None = None, batch: Column | None = None) -> Table:
        """Upsert by key: rows whose key is in ``incoming`` are replaced, others kept; written but not published.

        ``incoming`` has one row a key and is evaluated once: it is written
        first, dealt into the table's buckets, which is all if there was no
        table. Then the buckets it has rows in are written anew from their old
        rows without its keys, and its own. Both sides of that anti-join meet
        within a bucket, and a bucket is written by one task: take as many as
        make them some hundred MB. ``batch`` tells the
        incoming rows, which are then counted where they land (``batch_rows``).
        """
        before = (at or self.snapshot()).tables.get(name)
        keys = (key,) if isinstance(key, str) else tuple(key)
        if before is not None:
            if before.kind != KEYED or before.key != keys:
                raise ValueError(f"{name} is not keyed by {keys}")
            buckets = before.buckets
            incoming = incoming.select(*before.struct.names)
        dealt = incoming.withColumn(BUCKET, self.bucket_of(keys, buckets)).repartition(BUCKET)
        if before is None:
            folder, counts = self._write(dealt, name, [BUCKET], watermark, batch)
            return Table(KEYED, incoming.schema.json(), self._bucket_parts(folder), keys, buckets, counts=counts)
        drop, counts = self._write(dealt, f"{name}/_batch", [BUCKET], watermark)
        touched = self._bucket_parts(drop)
        marked = T.StructType([*before.struct.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(marked).parquet(f"{self.root}/{drop}")
        old = self.frame(before, list(touched)).withColumn(BUCKET, self.bucket_of(keys, buckets))
        rows = old.join(rows.select(BUCKET, *keys), [BUCKET, *keys], "left_anti").select(*marked.names).unionAll(rows)
        folder, kept = self._write(rows.repartition(BUCKET), name, [BUCKET], batch=batch)
        fs, p = file_system(self.spark, f"{self.root}/{drop}")
        fs.delete(p, True)
        counts = {**counts, **({"batch_rows": kept["batch_rows"]} if batch is not None else {})}
        return Table(KEYED, before.schema, {**before.parts, **self._bucket_parts(folder)}, keys, buckets, counts=counts)

    # ---------------------------------------------------------------- publishing
    def commit(self, changes: dict[str, Table], base: Snapshot) -> Snapshot:
        """Publish written tables in one step, as changes of the state ``base`` they were made from.

        Changes that others published meanwhile are kept if they touch no part
        that this one changes; else ``Conflict`` is raised and nothing is published.
        """
        now = base
        for _ in range(PUBLISH_ATTEMPTS):
            tables = dict(now.tables)
            for name, table in changes.items():
                tables[name] = table if now is base else self._rebased(name, table, base, now)
            text = json.dumps({"tables": {n: t.as_dict() for n, t in tables.items()}})
            number = now.number + 1
            if create_once(self.spark, f"{self.root}/{MANIFESTS}/{number:012d}", text):
                return Snapshot(number, tables)
            now = self.snapshot()
        raise Conflict(f"not published after {PUBLISH_ATTEMPTS} attempts")

    @staticmethod
    def _rebased(name: str, table: Table, base: Snapshot, now: Snapshot) -> Table:
        """``table`` made from ``base``, as a change of ``now``."""
        was, theirs = base.tables.get(name), now.tables.get(name)
        if theirs == was:
            return table
        old = was.parts if was else {}
        if theirs is None or table.kind == FULL or replace(theirs, parts={}) != replace(table, parts={}):
            raise Conflict(f"{name} was changed by another load")
        mine = {k: p for k, p in table.parts.items() if old.get(k) != p}
        both = [k for k in mine if theirs.parts.get(k) != old.get(k)]
        if both:
            raise Conflict(f"{name}: another load changed the same parts {sorted(both)[:5]}")
        return replace(theirs, parts={**theirs.parts, **mine})

    def expire(self, keep: int = 2) -> int:
        """Delete all states but the newest ``keep`` (at least one) and the directories that only they name; returns how many went.

        Keep more than one while readers may still hold an older state. Data
        that is written but not published yet is left alone.
        """
        numbers = self.numbers()
        gone, live = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
        named = {p for n in live for t in self.snapshot(n).tables.values() for p in t.parts.values()}
        for n in gone:
            for path in sorted({p for t in self.snapshot(n).tables.values() for p in t.parts.values()} - named):
                fs, p = file_system(self.spark, f"{self.root}/{path}")
                fs.delete(p, True)
            fs, p = file_system(self.spark, f"{self.root}/{MANIFESTS}/{n:012d}")
            fs.delete(p, False)
        return len(gone)
