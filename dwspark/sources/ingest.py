"""Extraction and file ingestion.

All readers return lazy DataFrames; only the CSV header check reads one line
to the driver (a bounded read) before the typed scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.functions.clean import strip_ws

BOM = "﻿"


class ContractError(ValueError):
    """The file does not match its declared header / row shape."""


def extract_since(df: DataFrame, col: str, last, lookback_days: int = 0) -> DataFrame:
    """Rows with ``col >= last - lookback`` (A02); no watermark -> everything.

    The predicate is a plain comparison with a literal, so it reaches the
    parquet scan as a pushed filter (row-group skipping).
    """
    if last is None:
        return df
    since = F.lit(last).cast(df.schema[col].dataType) if not isinstance(last, Column) else last
    if lookback_days:
        since = since - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    return df.filter(F.col(col) >= since)


def extract_child_since(child: DataFrame, parent: DataFrame, key: str, parent_col: str, since, parent_key: str | None = None) -> DataFrame:
    """Children (no date of their own) whose parent is in range (A03): a left-semi join."""
    pk = parent_key or key
    p = parent.filter(F.col(parent_col) >= F.lit(since)).select(F.col(pk).alias("__pk"))
    return child.join(p, child[key] == F.col("__pk"), "left_semi")


def _header_line(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ContractError(f"{path}: empty file")
    return first[0][0]


def check_header(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> None:
    """Header, BOM removed, trimmed and lower-cased, must equal ``columns`` in order."""
    head = _header_line(spark, path).lstrip(BOM)
    got = [h.strip().lower() for h in head.split(sep)]
    if got != [c.lower() for c in columns]:
        raise ContractError(f"{path}: header {got} != expected {columns}")


def read_csv_contract(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """CSV with a header contract, all columns as text, ragged rows rejected.

    Cells are trimmed (leading/trailing whitespace) and empty cells become
    NULL; records whose every cell is blank are skipped.
    """
    check_header(spark, path, columns, sep)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return blank_to_null(df)


def blank_to_null(df: DataFrame, data_columns: list[str] | None = None) -> DataFrame:
    """Trim every text cell, '' -> NULL, drop rows whose data columns are all NULL."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.withColumns({c: F.nullif(strip_ws(c), F.lit("")) for c in cols})
    return out.dropna(how="all", subset=data_columns or df.columns)


def read_csv_numbered(spark: SparkSession, path: str, columns: list[str], sep: str = ",", with_file: bool = False) -> DataFrame:
    """CSV rows with ``_row_number`` = record number in the file, header = 1 (A05); ``with_file`` adds the file's name as ``_file``.

    Distributed: each line gets ``monotonically_increasing_id`` (consecutive
    within a split); per (file, split) the first id and the line count are
    aggregated - one row per split, a small frame - and a running sum over
    the splits of a file gives the lines before each split. That frame is
    broadcast, so the lines are never dealt by their few splits, nor sorted.
    Limit: quoted fields must not contain newlines.
    """
    check_header(spark, path, columns, sep)
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("__f"),
        F.col("_metadata.file_block_start").alias("__b"),
        F.monotonically_increasing_id().alias("__id"),
    )
    splits = lines.groupBy("__f", "__b").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__f").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("__before", F.coalesce(before, F.lit(0)))
    numbered = lines.join(F.broadcast(splits), ["__f", "__b"]).withColumn(
        "_row_number", F.col("__id") - F.col("__first") + F.col("__before") + 1
    )
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    # the header record parses to NULL inside the expression (not only filtered out), so no
    # downstream predicate - whatever order the optimizer evaluates it in - ever sees its text
    # (FAILFAST alone does not see a record with cells to spare, so one more column catches these)
    wide = T.StructType([*schema.fields, T.StructField("__more", T.StringType(), True)])
    cells = F.from_csv("value", wide.simpleString(), {"sep": sep, "mode": "PERMISSIVE"})
    n_cells = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), re.escape(sep), -1))
    ragged = F.raise_error(F.concat(F.lit("ragged record, row "), F.col("_row_number").cast("string"))).cast(wide.simpleString())
    blank = F.trim(F.regexp_replace("value", r"[\s" + re.escape(sep) + "]", "")) == ""
    # row 1 of every file is checked, not only the first file's
    head = F.transform(F.split(F.lower(F.ltrim("value", F.lit(BOM))), re.escape(sep), -1), F.trim)
    other = F.raise_error(F.concat(F.lit("header differs: "), F.col("value"))).cast(wide.simpleString())
    rec = (
        F.when((F.col("_row_number") == 1) & (head != F.array(*[F.lit(c.lower()) for c in columns])), other)
        .when((F.col("_row_number") > 1) & ~blank, F.when(n_cells != len(columns), ragged).otherwise(cells))
    )
    lineage = [F.col("_row_number"), *([F.col("__f").alias("_file")] if with_file else [])]
    parsed = numbered.select(rec.alias("r"), *lineage).filter(F.col("r").isNotNull())
    return blank_to_null(parsed.select("r.*", *[c for c in parsed.columns if c != "r"]).drop("__more"), columns)


def read_csv_positional(spark: SparkSession, path: str, names: list[str], skip_header: bool = True, sep: str = ",") -> DataFrame:
    """Headerless (or header-skipped) CSV with names assigned by position."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return spark.read.schema(schema).option("header", skip_header).option("sep", sep).csv(path)


def read_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (A08). Prefer an explicit schema: inference scans the file once more."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str, fill: dict | None = None, mode: str = "overwrite") -> None:
    """CSV export with header (A16); ``fill`` replaces NULLs first (e.g. spend -> 0.0)."""
    out = df.fillna(fill) if fill else df
    out.write.mode(mode).option("header", True).csv(path)
