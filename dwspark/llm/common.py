"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.session import scratch_path
from dwspark.sources.tables import Tables

#: Words of the contracts: runs of ASCII letters, digits and every non-ASCII character, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_RE = re.compile(WORD)
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text: str | None) -> list[str]:
    """Words of a text; null and empty texts have none."""
    return WORD_RE.findall(text.translate(_ASCII_LOWER)) if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return Tables(spark, sf_dir)[name]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing
    everything before them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_digest(col: Column) -> Column:
    """128-bit digest of a text as two longs; null is the empty text."""
    t = F.coalesce(col, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.concat(t, F.lit("\u0001"))).alias("b"))


def batches(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of at most ``size`` rows."""
    out: list = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield out
            out = []
    if out:
        yield out


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that their Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(ship, "sent", None) == sc.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="dwspark-code-")) / "dwspark_code.zip"  # Spark copies it to the executors
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    ship.sent = sc.applicationId
