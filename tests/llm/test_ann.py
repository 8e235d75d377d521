"""Operator 10: recall and exactness against brute force."""

import numpy as np
from dwspark.llm import ann

SCHEMA = "vec_id long, embedding array<float>, v string, part int"


def vectors(n=6000, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    x = centres[rng.integers(0, 20, n)] + 0.3 * rng.normal(size=(n, dim))
    x[: n // 3] = rng.normal(size=(n // 3, dim))
    x[-500:] = x[-1]  # one very common vector
    return x.astype(np.float32)


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(c) for c in v], "x", 0) for i, v in zip(ids if ids is not None else range(len(x)), x)], SCHEMA)


def test_recall_order_and_distances(spark):
    x = vectors()
    got = {}
    for r in ann.nearest(frame(spark, x).repartition(6), sample_rows=2000).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, len(x), 100))
    ids, wide, hit = np.arange(len(x)), x.astype(np.float64), 0
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
        assert all(abs(s - np.sqrt(((wide[i] - wide[q]) ** 2).sum())) < 1e-12 and i != q for _, i, s in rows)
        hit += len({i for _, i, _ in rows} & {i for i, _ in ann.brute_force(ids, wide, q)})
    assert hit >= 0.9 * 10 * len(got)
    # ties of equal vectors go to the smaller ids
    assert [i for _, i, _ in got[len(x) - 100]] == list(range(len(x) - 500, len(x) - 490))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (None, [1.0, 0.5]), (100, [2.0, 0.0])]
    df = spark.createDataFrame([(i, v, "", 1) for i, v in rows], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df).collect())
    assert got == [(0, 1, 8, 1.0), (0, 2, 100, 1.0), (100, 1, 0, 1.0), (100, 2, 8, np.sqrt(2.0))]


def test_empty_and_lonely(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ann.nearest(frame(spark, np.ones((1, 4)))).count() == 0


def test_partitions_are_balanced_and_follow_the_graph():
    x = vectors(2000).astype(np.float64)
    graph = ann.neighbour_graph(x, 10)
    part = ann.balanced_partitions(x, graph, 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.15 * 2000 / 8)
    assert (part[graph] == part[:, None]).mean() > 0.45
