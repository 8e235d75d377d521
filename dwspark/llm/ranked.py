"""Operator 11: ranked lexical search, reversed: the items are indexed and the documents stream past.

The items' terms are few against the documents', so the inverted index is
over the items and is broadcast, in blocks of at most about
``block_postings`` (item, term) pairs. For each block:

1. the documents are read once; each leaves its number of terms and its counts
   of the items' terms, written (texts are not shuffled);
2. the number of documents that hold a term is counted over all of them;
3. each task streams the counts through the index and keeps, for each item, a
   heap of the ``k`` best documents, so a task's memory is bounded by the
   block, however many documents it reads;
4. heaps are merged in two steps: those of every ``MERGE``-th task, then these.

Scores are whole numbers. A term's weight is floor(1000 ln((2N+2)/(2df+1)));
a document's length norm m is 75 + (25 n N) div L; the score sums
weight * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included.

Defined cases: null and empty texts have no terms, are not counted in N and
are in no result; an item id on several rows is one item with the terms of
all of them, a null id too; repeated documents are ranked one by one, equal
scores by ascending id, null ids last; items without terms and empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.llm.common import written

#: Runs of ASCII letters, digits and all non-ASCII characters, of the text with A-Z lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_POSTINGS = 1 << 20
MERGE = 256
_NO_ID = -(1 << 63)

# The same on UTF-8 bytes: A-Z as a-z, every other byte below 0x80 that is no letter or digit as a space.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """Terms of a text's UTF-8 bytes."""
    return raw.translate(_FOLD).split()


class Index:
    """Inverted index over a block of items: for each term the items that hold it and how often."""

    def __init__(self, postings: list[tuple[int, str, int]]):
        names = sorted({t for _, t, _ in postings})
        self.numbers = {t.encode(): i for i, t in enumerate(names)}
        rows = sorted((self.numbers[t.encode()], item, times) for item, t, times in postings)
        self.item = np.array([r[1] for r in rows], dtype=np.int64)
        self.times = np.array([r[2] for r in rows], dtype=np.int64)
        self.first = np.searchsorted(np.array([r[0] for r in rows], dtype=np.int64), np.arange(len(names) + 1))
        self.items = int(self.item.max()) + 1 if rows else 0


class Heaps:
    """The ``k`` best (score, document) of each item; greater keys are better."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)  # a lower score can't enter
        self.sums = np.zeros(items, dtype=np.int64)

    def add(self, doc: int, of: np.ndarray, scores: np.ndarray) -> None:
        """Parts of the document's scores for items ``of``, which may repeat."""
        self.sums[of] = 0
        np.add.at(self.sums, of, scores)
        for i in np.unique(of[self.sums[of] >= self.least[of]]).tolist():
            heap, key = self.heaps[i], (int(self.sums[i]), doc)
            if len(heap) < self.k:
                heapq.heappush(heap, key)
            elif key > heap[0]:
                heapq.heapreplace(heap, key)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]


def _counts(docs: DataFrame, index, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``n`` and the counts of the index's terms, of every document with a term."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))

    def count(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = index.value.numbers
        for b in got:
            keep, n, ids, times = [], [], [], []
            for k, t in enumerate(b.column(1)):
                found = Counter(terms(t.as_buffer().to_pybytes())) if t.is_valid else None
                if found:
                    keep.append(k)
                    n.append(found.total())
                    mine = {numbers[w]: c for w, c in found.items() if w in numbers}
                    ids.append(list(mine))
                    times.append(list(mine.values()))
            arrays = [b.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "n", "terms", "times"])

    return rows.mapInArrow(count, "doc long, n long, terms array<int>, times array<long>")


def _expand(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for all values starts[row] .. starts[row] + sizes[row] - 1."""
    row = np.repeat(np.arange(len(starts)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _best(counts: DataFrame, index, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item``, ``doc``, ``score``: the heaps of each task."""

    def score(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, w = index.value, weights.value
        best = Heaps(ix.items, k)
        for b in got:
            ids, times = b.column(2), b.column(3)
            at, flat, tf = ids.offsets.to_numpy(), ids.values.to_numpy(), times.values.to_numpy()
            for row, (doc, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                mine, t = flat[at[row] : at[row + 1]], tf[at[row] : at[row + 1]]
                m = 75 + (25 * n * n_docs) // n_terms
                part = w[mine] * ((1_000_000_000 * t) // (1000 * t + 12 * m))
                of, posting = _expand(ix.first[mine], ix.first[mine + 1] - ix.first[mine])
                if len(of):
                    best.add(_NO_ID if doc is None else -doc, ix.item[posting], ix.times[posting] * part[of])
        rows = [(i, None if d == _NO_ID else -d, s) for i, heap in enumerate(best.heaps) for s, d in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["item", "doc", "score"])

    return counts.mapInArrow(score, "item long, doc long, score long")


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def postings_of(items: DataFrame) -> DataFrame:
    """``item_id``, ``term``, ``times`` of all items (``item_id``, ``text``)."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term"))
    return found.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_postings: int = BLOCK_POSTINGS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents of each item; ids of documents are integers."""
    spark = docs.sparkSession
    postings = written(postings_of(items), "postings")
    blocks = -(-postings.count() // block_postings)
    id_type = items.schema["item_id"].dataType
    out = spark.createDataFrame([], T.StructType([T.StructField("item_id", id_type), *T._parse_datatype_string(f"rank int, {id_col} long, score long").fields]))
    for block in range(blocks):
        mine = postings.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        ids = list({r["item_id"] for r in mine})
        number = {i: n for n, i in enumerate(ids)}
        if not ids:
            continue
        built = Index([(number[r["item_id"]], r["term"], r["times"]) for r in mine])
        index = spark.sparkContext.broadcast(built)
        counts = written(_counts(docs, index, id_col, text_col), "term-counts")
        n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg((1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.count(F.lit(1)) + 1))).alias("w"))
        w = np.zeros(len(built.numbers), dtype=np.int64)
        for r in held.select("term", F.floor("w").alias("w")).collect():  # at most the block's terms
            w[r["term"]] = r["w"]
        weights = spark.sparkContext.broadcast(w)
        best = _best(counts, index, weights, n_docs, n_terms, k).withColumn("task", F.pmod(F.spark_partition_id(), F.lit(MERGE)))
        best = _top(_top(best, ["item", "task"], k).drop("rank"), ["item"], k)
        names = spark.createDataFrame([(n, i) for i, n in number.items()], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type)]))
        found = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
        out = out.unionAll(written(found, "ranked"))
        index.unpersist()
        weights.unpersist()
    return out
