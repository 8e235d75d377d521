"""Operator 8: n-gram Jaccard join by chosen paths.

A document is its set of hashed word shingles. Texts with equal sets are one
class; only classes are joined.

Chosen paths: a path starts empty; each level extends it by the elements of
the set whose hash under that path is below ``BRANCH`` / set size, and by the
one of smallest hash. Similar sets choose the same elements, so they meet in
the bucket of a common path; ``runs_for`` repeats this with other hashes until
the target recall holds over all levels, also the longer paths of large
buckets. Buckets of one are dropped.

* Buckets of at most ``SMALL`` classes go to brute force at once.
* In a larger one each class is compared with the bucket's pivot (its smallest class).
  Those at Jaccard ``CORE_LOW`` or more are a cluster and go to brute force;
  those under ``rest_high(threshold)`` go on recursively by longer paths; what is still
  in a large bucket after ``MORE_DEPTH`` levels goes to brute force as well. Jaccard
  distance is a metric, so a pair at the threshold is on one side together.

Brute force takes, for each pivot, the classes that share a bucket of that
pivot with it, cut into pairs of blocks of at most ``BLOCK`` classes, one Spark group
each, and compares them exactly by products of 0/1 matrices. A pair that meets
under several pivots counts at the one of smallest hash. What leaves a block is one row a
class (its number of linked documents) and one edge a class towards the
smallest linked class, never all pairs.

Defined cases: a null text is empty; a text without words is similar to
nothing; one with fewer words than a shingle has one shingle of all of them;
rows equal in id and text count as so many documents of a class; a class has a
null id only if all its documents do; other columns are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.common import written
from dwspark.llm.components import components
from dwspark.llm.decontam import word_hashes
from dwspark.llm.spans import FILTER_WORDS, _bitmap

BRANCH, DEPTH = 2.0, 3
# Longer paths of large buckets: 1.2 children a level, so that groups of middling similarity don't multiply;
# a pair at 0.8 starts with some 5 common paths a run and has 0.87 children of each a level.
MORE_BRANCH, MORE_DEPTH = 0.75, 5
SMALL, BLOCK, BLOCK_SHINGLES = 64, 1024, 1 << 22
PIVOT_ROWS = 256
CORE_LOW = 0.5
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def run_recall(threshold: float = 0.8) -> float:
    """Probability that a pair at Jaccard ``threshold`` has a common path of one run through all levels, also those of large buckets.

    Common paths are a branching process. This is the pair of which one set
    holds the other; others share more paths. The larger set chooses a Poisson
    number of elements, or else its smallest, and the smaller one has each
    with probability ``threshold``.
    """
    ends = 0.0
    for branch in [MORE_BRANCH] * MORE_DEPTH + [BRANCH] * DEPTH:
        ends = math.exp(-branch * threshold * (1 - ends)) - math.exp(-branch) * threshold * (1 - ends)
    return 1 - ends


def runs_for(recall: float, threshold: float = 0.8) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(max(1e-9, 1 - run_recall(threshold)))))


def rest_high(threshold: float) -> float:
    """By the triangle inequality, of two sets at ``threshold`` both are under this or both at ``CORE_LOW`` or more."""
    return CORE_LOW + 1 - threshold + 1e-9


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words."""
    h = word_hashes(np.frombuffer((text or "").encode(), dtype=np.uint8))[2]
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), dtype=np.uint64)
    for k in range(min(size, len(h))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


def extend(own: np.ndarray, paths: np.ndarray, branch: float = BRANCH) -> tuple[np.ndarray, np.ndarray]:
    """(number of the path, longer path) for the elements each path chooses from the set ``own``."""
    below = np.uint64(min(2**64 - 1, int(branch / len(own) * 2**64)))
    of, out = [], []
    step = max(1, (1 << 18) // len(own))  # some 2 MB at a time
    for a in range(0, len(paths), step):
        h = _mix(own[None, :] ^ paths[a : a + step, None])
        take = h <= below
        take[np.arange(len(h)), h.argmin(axis=1)] = True
        p, z = np.nonzero(take)
        of.append(p + a)
        out.append(_mix(h[p, z] + _M2))
    return np.concatenate(of), np.concatenate(out)


def chosen_paths(own: np.ndarray, runs: int, depth: int = DEPTH) -> np.ndarray:
    paths = _mix(np.arange(1, runs + 1, dtype=np.uint64) * _M1)
    for _ in range(depth):
        paths = extend(own, paths)[1]
    return np.unique(paths)


def _rows(column: pa.Array, take: list[int] | np.ndarray) -> pa.Array:
    return column.take(pa.array(np.asarray(take, dtype=np.int64)))


def _longs(h: np.ndarray) -> pa.Array:
    return pa.array(h.astype(np.uint64).view(np.int64), pa.int64())


class _Join:
    def __init__(self, docs: DataFrame, threshold: float, size: int, recall: float, id_col: str, text_col: str):
        if not 0 < threshold <= 1:
            raise ValueError(f"threshold is above 0 and at most 1, not {threshold!r}")
        self.spark, self.t, self.size, self.runs = docs.sparkSession, threshold, size, runs_for(recall, threshold)
        id_type = self.id_type = docs.schema[id_col].dataType.simpleString()
        self.node = f"struct<id:{id_type},a:bigint,b:bigint>"
        rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        runs = self.runs

        def sets(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in got:
                digests, sizes, paths = [], [], []
                for t in batch.column(1):
                    own = shingles(t.as_py(), size)
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                    sizes.append(len(own))
                    paths.append(_longs(chosen_paths(own, runs)) if len(own) else pa.array([], pa.int64()))
                d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                ends = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(paths) if paths else pa.array([], pa.int64()))
                yield pa.record_batch({"id": batch.column(0), "a": pa.array(d[:, 0]), "b": pa.array(d[:, 1]), "n": pa.array(sizes, pa.int64()), "paths": lists})

        schema = f"id {id_type}, a long, b long, n long, paths array<long>"
        found = rows.mapInArrow(sets, schema)
        # classes of equal sets; copies meet in the tasks first
        classes = found.groupBy("a", "b").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("paths").alias("paths"))
        self.classes = written(classes.select(F.struct("id", "a", "b").alias("node"), "copies", "n", "paths"), "classes")
        self.rows = rows

    def texts(self, nodes: DataFrame, name: str = "class-texts") -> DataFrame:
        """``nodes`` (column node, any others) with the texts of these classes, written.

        The text is that of the smallest id; hashes of id and words spread even a third of equal documents.
        """
        size = self.size
        # a bitmap of the wanted ids, of fixed size, keeps other texts from being hashed and shuffled
        bits = self.spark.sparkContext.broadcast(_bitmap(nodes.select(F.xxhash64("node.id").alias("h"))))

        def digests(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in got:
                at = np.mod(batch.column(2).to_numpy(), 64 * FILTER_WORDS)
                batch = batch.take(pa.array(np.flatnonzero((bits.value[at >> 6] >> (at & 63)) & 1)))
                d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(shingles(t.as_py(), size).tobytes()) for t in batch.column(1)), dtype="<i8").reshape(-1, 2)
                yield pa.record_batch({"id": batch.column(0), "text": batch.column(1), "a": pa.array(d[:, 0]), "b": pa.array(d[:, 1])})

        own = self.rows.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(digests, f"id {self.id_type}, text string, a long, b long")
        own = own.groupBy(F.struct("id", "a", "b").alias("k")).agg(F.min("text").alias("text"))
        out = written(nodes.join(own.hint("merge"), F.col("node") == F.col("k")).drop("k"), name)
        bits.unpersist()
        return out

    def buckets(self, frontier: DataFrame) -> DataFrame:
        """Rows path, node, pivot, members of the buckets of two or more. ``frontier`` is read twice: first by hash alone."""
        counted = frontier.groupBy(F.col("path").alias("h")).agg(F.count("*").alias("n"))
        bits = self.spark.sparkContext.broadcast(_bitmap(counted.where("n > 1").select("h")))

        def shared(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in got:
                at = np.mod(batch.column(0).to_numpy(), 64 * FILTER_WORDS)
                yield batch.take(pa.array(np.flatnonzero((bits.value[at >> 6] >> (at & 63)) & 1)))

        few = written(frontier.mapInArrow(shared, f"path long, node {self.node}"), "shared-paths")
        bits.unpersist()
        pivots = few.groupBy("path").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where("members > 1")
        return written(few.join(written(pivots, "pivots").hint("merge"), "path"), "buckets")

    def meetings(self) -> DataFrame:
        """Distinct rows pivot, node: classes to be compared with each other under a pivot."""
        frontier = self.classes.select(F.explode("paths").alias("path"), "node")
        done, held = [], None
        for depth in range(MORE_DEPTH + 1):
            found = self.buckets(frontier)
            done.append(found.where(F.col("members") <= SMALL).select("pivot", "node"))
            large = found.where(F.col("members") > SMALL).select("path", "pivot", "node", "members")
            if large.isEmpty():
                break
            if depth == MORE_DEPTH:
                done.append(large.select("pivot", "node"))
                break
            if held is None:  # members of later large buckets are among those of the first
                held = self.texts(large.select("node").distinct(), "large-bucket-texts").hint("merge")
            core, rest = self.split(large, held)
            done.append(core)
            frontier = self.longer(rest, held)
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return written(out.distinct(), "meetings")

    def split(self, large: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of large buckets near their pivot, and the rows path, node of those that are not."""
        # a pivot's text is repeated for every PIVOT_ROWS of its members, so that those of a large bucket are dealt to many tasks
        pairs = large.groupBy("pivot", "node").agg(F.max("members").alias("members"))
        salts = F.ceil(F.col("members") / PIVOT_ROWS)
        left = pairs.join(held, "node").withColumn("salt", F.pmod(F.xxhash64("node"), salts))
        # a pivot is a member of its bucket
        pivots = pairs.groupBy(F.col("pivot").alias("node")).agg(F.max("members").alias("members")).join(held, "node")
        right = pivots.select(F.col("node").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("s"), F.col("text").alias("pivot_text"))
        size = self.size

        def compare(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last: tuple = (None, None)
            for batch in got:
                out = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    y = y.as_py()
                    if y != last[0]:
                        last = (y, shingles(y, size))
                    own = shingles(x.as_py(), size)
                    both = len(np.intersect1d(own, last[1], assume_unique=True))
                    out.append(both / (len(own) + len(last[1]) - both))
                yield pa.record_batch({"pivot": batch.column(0), "node": batch.column(1), "j": pa.array(out, pa.float64())})

        j = left.join(right, (F.col("pivot") == F.col("p")) & (F.col("salt") == F.col("s"))).select("pivot", "node", "text", "pivot_text").mapInArrow(compare, f"pivot {self.node}, node {self.node}, j double")
        j = written(j, "pivot-similarity")
        far = j.where(F.col("j") < rest_high(self.t)).select("pivot", "node")
        return j.where(F.col("j") >= CORE_LOW).select("pivot", "node"), large.join(far, ["pivot", "node"], "left_semi").select("path", "node")

    def longer(self, rest: DataFrame, held: DataFrame) -> DataFrame:
        """The paths of ``rest``, each one level longer."""
        size = self.size

        def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in got:
                of, out = [], []
                for i, (paths, t) in enumerate(zip(batch.column(1), batch.column(2))):
                    new = extend(shingles(t.as_py(), size), np.array(paths.as_py(), dtype=np.int64).view(np.uint64), MORE_BRANCH)[1]
                    of.append(np.full(len(new), i))
                    out.append(new)
                if of:
                    yield pa.record_batch({"path": _longs(np.concatenate(out)), "node": _rows(batch.column(0), np.concatenate(of))})

        # a class has at most some dozens of paths
        nodes = rest.groupBy("node").agg(F.collect_set("path").alias("paths"))
        return written(nodes.join(held, "node").select("node", "paths", "text").mapInArrow(run, f"path long, node {self.node}"), "longer-paths")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(node, links, link classes) and edges (u, v) between linked classes."""
        meet = self.meetings()
        info = self.classes.select("node", "copies", "n")
        # blocks are bounded in members and in shingles
        sizes = meet.join(info, "node").groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        pivots = meet.groupBy("node").agg(F.sort_array(F.collect_set(F.xxhash64("pivot"))).alias("pivots"))
        nodes = self.texts(pivots.join(info, "node"), "compared")
        group = meet.join(written(sizes, "group-sizes"), "pivot")
        group = group.select("pivot", "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
        # each class goes to all pairs of its block and another
        group = group.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        group = group.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")
        full = group.join(nodes.hint("merge"), "node").select("pivot", F.xxhash64("pivot").alias("pivot_hash"), "i", "j", "block", "node", "pivots", "copies", "text")
        node_type = self.node
        compare = _block_comparer(self.t, self.size)
        out = full.groupBy("pivot", "i", "j").applyInArrow(compare, f"node {node_type}, links long, classes long, least {node_type}")
        out = written(out, "links")
        counts = out.groupBy("node").agg(F.sum("links").alias("links"), F.sum("classes").alias("link_classes"))
        return counts, out.where("node != least").select(F.col("node").alias("u"), F.col("least").alias("v"))


def _order(node: dict):
    return (node["id"] is not None, node["id"] if node["id"] is not None else 0, node["a"], node["b"])


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 2048) -> np.ndarray:
    """Numbers of common elements of the sets ``left`` with the sets ``right``, by products of 0/1 matrices."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1  # others meet nothing
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column, n = row[order], column[order], int((count > 1).sum())
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for a in range(0, n, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        m = np.zeros((len(sets), min(width, n - a)), dtype=np.float32)
        m[row[lo:hi], column[lo:hi] - a] = 1
        out += m[left] @ m[right].T
    return out


def _block_comparer(t: float, size: int):
    def run(group: pa.Table) -> pa.Table:
        node = group["node"].combine_chunks()
        node = node.chunk(0) if isinstance(node, pa.ChunkedArray) else node
        order = [_order(n) for n in node.to_pylist()]
        sets = [shingles(x.as_py(), size) for x in group["text"]]
        sizes, copies, block = np.array([len(s) for s in sets], dtype=np.float64), group["copies"].to_numpy(), group["block"].to_numpy()
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        linked = _common(sets, left, right).astype(np.float64) * (1 + t) >= t * (sizes[left][:, None] + sizes[right][None, :]) - 1e-6
        if i == j:
            np.fill_diagonal(linked, False)
        links, classes = np.zeros(len(sets), dtype=np.int64), np.zeros(len(sets), dtype=np.int64)
        label = np.empty(len(sets), dtype=np.int64)  # of each class, the rank of the smallest that chains of links lead to
        by_rank = np.array(sorted(range(len(sets)), key=order.__getitem__), dtype=np.int64)
        label[by_rank] = np.arange(len(sets))
        if linked.any():
            # a pair that also meets under a pivot of smaller hash counts there
            pivot = group["pivot_hash"][0].as_py()
            before = [p[p < pivot] for p in (x.values.to_numpy() for x in group["pivots"])]
            others = np.unique(np.concatenate(before))
            counted = linked
            if len(others):
                own = np.zeros((len(sets), len(others)), dtype=np.float32)
                for r, b in enumerate(before):
                    own[r, np.searchsorted(others, b)] = 1
                counted = linked & (own[left] @ own[right].T == 0)
            links[left], classes[left] = counted @ copies[right], counted.sum(axis=1)
            if i != j:
                links[right], classes[right] = counted.T @ copies[left], counted.sum(axis=0)
            rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            part, x, y = linked[np.ix_(rows, columns)], left[rows], right[columns]
            while True:
                old = label.copy()
                label[x] = np.minimum(label[x], np.where(part, label[y][None, :], len(sets)).min(axis=1))
                label[y] = np.minimum(label[y], np.where(part, label[x][:, None], len(sets)).min(axis=0))
                if (old == label).all():
                    break
        least = by_rank[label]
        keep = np.flatnonzero((classes > 0) | (least != np.arange(len(sets))))
        return pa.table({"node": node.take(pa.array(keep)), "links": pa.array(links[keep]), "classes": pa.array(classes[keep]), "least": node.take(pa.array(least[keep]))})

    return run


def jaccard_join(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, recall: float = 0.9995, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``row`` (struct of all columns), ``class_id``, ``n_links``, ``group_id``, ``first``.

    class_id: smallest id among the documents with the same shingles. n_links:
    number of other documents at Jaccard ``threshold`` or more. group_id:
    smallest id that chains of links lead to. first: does this document, the
    smallest id of the smallest class, stand for its group? (Rows that repeat its id are all marked.)
    """
    join = _Join(docs, threshold, shingle, recall, id_col, text_col)
    counts, edges = join.links()
    roots = components(edges).select(F.col("u").alias("node"), F.col("v").alias("root"))
    classes = join.classes.select("node", "copies", "n").join(counts, "node", "left").join(roots, "node", "left")
    classes = classes.select(F.col("node.a").alias("a"), F.col("node.b").alias("b"), F.col("node.id").alias("class_id"), "copies", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    classes = written(classes, "class-results")

    def digests(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(shingles(t.as_py(), shingle).tobytes()) for t in batch.column(1)), dtype="<i8").reshape(-1, 2)
            yield pa.record_batch({"row": batch.column(0), "a": pa.array(d[:, 0]), "b": pa.array(d[:, 1])})

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    keyed = whole.mapInArrow(digests, f"row {whole.schema['row'].dataType.simpleString()}, a long, b long")
    own = F.col("row").getField(id_col)
    alone = F.col("n") == 0
    out = keyed.join(classes.hint("merge"), ["a", "b"])
    return out.select(
        "row",
        F.when(alone, own).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(alone, own).otherwise(F.col("root.id")).alias("group_id"),
        (alone | ((F.col("root.a") == F.col("a")) & (F.col("root.b") == F.col("b")) & own.eqNullSafe(F.col("root.id")))).alias("first"),
    )
