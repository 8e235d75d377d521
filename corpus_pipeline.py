"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes all that the one before kept and writes what it keeps as
Parquet, from which the next one reads. Every stage but the last returns the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.llm import decontam, jaccard, packing, spans, toxicity
from dwspark.llm.common import ship, table, written
from dwspark.llm.queries import byte_bpe


#: Rows of an Arrow batch: the texts of so many documents are in a task at once, in the JVM and in its Python worker.
BATCH_ROWS = "1000"


def _prepare(spark: SparkSession) -> None:
    """The package on the executors, and Arrow batches of fewer rows than Spark's default."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _as_documents(out: DataFrame, columns: list[str], changed: bool = False) -> DataFrame:
    """The columns of ``documents`` from an operator's ``row`` and ``text``; n_chars follows a changed text."""

    def pick(c: str):
        if c == "text":
            return F.col("text")
        if c == "n_chars" and changed:
            return F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row").getField(c)).alias(c)
        return F.col("row").getField(c).alias(c)

    return out.select(*[pick(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score at the threshold or above go."""
    _prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _as_documents(toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD), docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines of later repeated windows go, and with them documents of which nothing is left."""
    _prepare(spark)
    out = spans.dedup_lines(docs, window=3)
    left = (F.col("n_removed") == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    return _as_documents(out.where(left), docs.columns, changed=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of chained links, the smallest document stays."""
    _prepare(spark)
    out = jaccard.jaccard_join(docs, threshold=0.8, shingle=5).where("first")
    kept = out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    # rows that repeat an id: the same document twice
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents of which the benchmark covers a twentieth or more go."""
    _prepare(spark)
    out = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=13)
    return _as_documents(out.where(~decontam.contaminated()), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the rest in sequences of at most 1024 tokens, one row a piece."""
    _prepare(spark)
    return packing.pack(docs, byte_bpe(), max_tokens=1024, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: The learned toxicity model can't be put in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
