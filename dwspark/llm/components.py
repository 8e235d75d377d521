"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.common import written


def _minima(edges: DataFrame) -> DataFrame:
    """Smallest of each node u and its neighbours v, combined in the tasks first; one row a node."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "minima")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows u, v: each node but the smallest of its component, with that smallest node.

    ``edges`` has comparable columns u and v. Each round writes its edges, so
    that no lineage grows; a node with very many edges is split by AQE, as its
    minimum comes from a table of one row a node.
    """
    now = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both), F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), "large-stars")
        least = _minima(large)
        small = large.join(least, F.col("u") == F.col("k")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).where("u != v").distinct(), "edges")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if state == before:
            return now
        before = state
    raise RuntimeError(f"components not found in {most_rounds} rounds")
