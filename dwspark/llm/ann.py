"""Operator 10: nearest neighbours by learned partitions.

Fit, on at most ``sample_rows`` vectors (taken by hash of their id): the graph
of nearest neighbours of the sample is cut into balanced partitions with few
cut edges; a small network then learns, for a vector, in which partitions its
neighbours lie. On vectors that it was not trained on, the share of
probability is set that a query must probe for the target recall.

There are about as many partitions as the square root of the rows, at every
size, up to ``MOST_PARTITIONS``.

Index: every row goes to its most probable partition. Search: a query goes to its most
probable partitions until their probabilities reach that share, and all rows of
these are compared exactly. A partition is cut into blocks of rows, and its
queries into blocks too, so that no task takes a whole partition, however
large a cluster of equal vectors is.

Defined cases: null, zero and empty vectors and those with null or non-finite
components take no part; vectors of one length are searched among themselves;
a null id takes no part; of rows that repeat an id the smallest vector counts;
a query with fewer candidates gets all it finds; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwspark.llm.common import written

SAMPLE_ROWS = 8_192
MOST_PARTITIONS = 64
BLOCK_ROWS, BLOCK_QUERIES = 4_096, 2_048


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k nearest other rows of each row."""
    square = (x * x).sum(axis=1)
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), 1024):
        d = square[None, :] - 2 * (x[a : a + 1024] @ x.T)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a : a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.15, rounds: int = 15, seed: int = 5) -> np.ndarray:
    """Partition of each row: at most ``slack`` times the mean size, few graph edges between partitions.

    Starts from centres, filled nearest first up to the capacity; then rows move to the
    partition that most of their graph neighbours are in, best gains first, while there is room.
    """
    rng = np.random.default_rng(seed)
    n, capacity = len(x), int(np.ceil(slack * len(x) / parts))
    centres = x[rng.choice(n, parts, replace=False)]
    for _ in range(8):
        near = ((centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)).argmin(axis=1)
        centres = np.stack([x[near == p].mean(axis=0) if (near == p).any() else x[rng.integers(n)] for p in range(parts)])
    d = (centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)
    part, size = np.full(n, -1), np.zeros(parts, dtype=np.int64)
    for r in np.argsort(d.min(axis=1)):
        for p in np.argsort(d[r]):
            if size[p] < capacity:
                part[r], size[p] = p, size[p] + 1
                break
    source = np.repeat(np.arange(n), graph.shape[1])
    ends = np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (ends[0], part[ends[1]]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        moved = 0
        for r in np.argsort(-gain):
            if gain[r] <= 0:
                break
            if size[best[r]] < capacity:
                size[part[r]] -= 1
                part[r] = best[r]
                size[part[r]] += 1
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: probability of each partition."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    share: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """Partitions to search for each query, most probable first."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1)
        before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
        return [o[b < self.share] for o, b in zip(order, before)]


def train(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, batch: int = 256, rate: float = 2e-3, seed: int = 5) -> Router:
    """Cross-entropy against the shares of neighbours in each partition, by Adam."""
    rng = np.random.default_rng(seed)
    dim, parts = x.shape[1], target.shape[1]
    r = Router(x.mean(axis=0), float(x.std()) or 1.0, rng.normal(0, np.sqrt(2 / dim), (dim, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts))
    names = ("w1", "b1", "w2", "b2")
    m, v = ({k: np.zeros_like(getattr(r, k)) for k in names} for _ in range(2))
    x, step = (x - r.mean) / r.scale, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            own = x[rows]
            h = np.maximum(own @ r.w1 + r.b1, 0)
            z = h @ r.w2 + r.b2
            p = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            dh = (dz @ r.w2.T) * (h > 0)
            step += 1
            for k, g in zip(names, (own.T @ dh + 1e-4 * r.w1, dh.sum(axis=0), h.T @ dz + 1e-4 * r.w2, dz.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                setattr(r, k, getattr(r, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
    return r


def fit_router(x: np.ndarray, parts: int, k: int = 10, recall: float = 0.97) -> Router:
    """Partition the sample's graph, train the router, and set its share for ``recall`` on rows kept from training."""
    k = max(1, min(k, len(x) - 1))
    parts = max(1, min(parts, len(x) // 4))
    if parts == 1:
        return train(x, np.ones((len(x), 1)), epochs=1)
    graph = neighbour_graph(x, k)
    part = balanced_partitions(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 1 / (k + 1))
    target[np.arange(len(x)), part] += 1 / (k + 1)
    held = np.arange(len(x)) % 5 == 0
    router = train(x[~held], target[~held])
    # where the index would put the sample, and what share of probability covers the held-out rows' neighbours
    p = router.probabilities(x)
    home = p.argmax(axis=1)
    order = np.argsort(-p[held], axis=1)
    ranked = np.take_along_axis(p[held], order, axis=1)
    before = np.cumsum(ranked, axis=1) - ranked
    position = np.argsort(order, axis=1)
    needed = np.take_along_axis(before, np.take_along_axis(position, home[graph[held]], axis=1), axis=1).ravel()
    router.share = float(min(1.0, np.quantile(needed, recall) + 1e-6))
    return router


def _valid(vectors: DataFrame) -> DataFrame:
    out = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return out.where(F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(-1, dim)


def _top(query: np.ndarray, query_ids: list, x: np.ndarray, ids: list, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, distances) of the k nearest rows, ties to the smaller id; a query's own id takes no part."""
    number = {v: r for r, v in enumerate(ids)}
    ids_array = np.array(ids)
    square, size = (x * x).sum(axis=1), max(1, (1 << 22) // max(1, len(x)))
    for a in range(0, len(query), size):
        q = query[a : a + size]
        d = square[None, :] - 2 * (q @ x.T) + (q * q).sum(axis=1)[:, None]
        slack = 1e-9 * (1 + square.max() + (q * q).sum(axis=1))
        for r in range(len(q)):
            own = number.get(query_ids[a + r])
            if own is not None:
                d[r, own] = np.inf
            n = len(x) - (own is not None)
            if n <= 0:
                continue
            # all rows that rounding could put among the k nearest, compared again exactly
            kth = np.partition(d[r], min(k, n) - 1)[min(k, n) - 1]
            rows = np.flatnonzero(d[r] <= kth + slack[r])
            exact = np.sqrt(((x[rows] - q[r]) ** 2).sum(axis=1))
            best = np.lexsort((ids_array[rows], exact))[:k]
            yield a + r, rows[best], exact[best]


def nearest(vectors: DataFrame, queries=None, k: int = 10, recall: float = 0.97, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows query_id, rank (from 1), vec_id, score (Euclidean distance).

    ``vectors``: vec_id and embedding. ``queries``: condition on vec_id; by
    default ids divisible by 100.
    """
    queries = F.col("vec_id") % 100 == 0 if queries is None else queries
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    base = _valid(vectors)
    lengths = base.groupBy(F.size("v").alias("dim")).count().orderBy("dim").collect()  # one row a length
    out = vectors.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    for n in lengths:
        out = out.unionAll(_nearest(base.where(F.size("v") == n["dim"]), n["dim"], n["count"], id_type, queries, k, recall, sample_rows))
    return out


def _nearest(base: DataFrame, dim: int, rows: int, id_type: str, queries, k: int, recall: float, sample_rows: int) -> DataFrame:
    """``nearest`` of valid vectors of length ``dim``."""
    spark = base.sparkSession
    if not base.groupBy("vec_id").count().where("count > 1").isEmpty():
        base = base.groupBy("vec_id").agg(F.min("v").alias("v"))
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow()
    parts = max(1, min(MOST_PARTITIONS, math.isqrt(rows)))
    router = spark.sparkContext.broadcast(fit_router(_matrix(sample["v"], dim), parts, k, recall))

    def place(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            home = router.value.probabilities(_matrix(batch.column(1), dim)).argmax(axis=1) if len(batch) else np.empty(0)
            yield pa.record_batch({"vec_id": batch.column(0), "v": batch.column(1), "part": pa.array(home.astype(np.int32))})

    def send(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            found = router.value.probes(_matrix(batch.column(1), dim)) if len(batch) else []
            of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.record_batch({"query_id": batch.column(0).take(of), "q": batch.column(1).take(of), "part": pa.array(np.concatenate([*found, []]).astype(np.int32))})

    index = written(base.mapInArrow(place, f"vec_id {id_type}, v array<double>, part int"), "ann-index")
    asked = written(base.where(queries).mapInArrow(send, f"query_id {id_type}, q array<double>, part int"), "ann-queries")
    # at most MOST_PARTITIONS rows
    row_blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    query_blocks = asked.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
    grid = F.broadcast(row_blocks.join(query_blocks, "part"))
    some = lambda n, c: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(grid, "part").select("part", some("row_blocks", "vec_id").alias("i"), every("query_blocks").alias("j"), "vec_id", "v")
    right = asked.join(grid, "part").select("part", every("row_blocks").alias("i"), some("query_blocks", "query_id").alias("j"), "query_id", "q")

    def compare(rows: pa.Table, asking: pa.Table) -> pa.Table:
        out: list = [[], [], []]
        if len(rows) and len(asking):
            ids, asker = rows["vec_id"].to_pylist(), asking["query_id"].to_pylist()
            for r, found, d in _top(_matrix(asking["q"], dim), asker, _matrix(rows["v"], dim), ids, k):
                out[0] += [asker[r]] * len(found)
                out[1] += [ids[f] for f in found]
                out[2] += d.tolist()
        return pa.table({"query_id": pa.array(out[0], rows.schema.field("vec_id").type), "vec_id": pa.array(out[1], rows.schema.field("vec_id").type), "score": pa.array(out[2], pa.float64())})

    cell = ["part", "i", "j"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(compare, f"query_id {id_type}, vec_id {id_type}, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: np.ndarray, x: np.ndarray, query: int, k: int = 10) -> list[tuple[int, float]]:
    """(id, distance) of the k nearest others of row ``query``; for tests and for measuring recall."""
    d = np.sqrt(((x - x[query]) ** 2).sum(axis=1))
    others = np.flatnonzero(ids != ids[query])
    best = others[np.lexsort((ids[others], d[others]))[:k]]
    return [(int(ids[b]), float(d[b])) for b in best]
