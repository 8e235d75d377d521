"""Operator 8 against all pairs."""

import random
from collections import Counter, defaultdict

import pytest
from dwspark.llm import jaccard
from dwspark.llm.common import words

SCHEMA = "doc_id long, text string, class_id string, node string, a string"


def all_pairs(rows, size=5):
    """{id: (class, links, group)} by comparing every pair that shares a shingle."""
    sets = {}
    for i, t in rows.items():
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links, parent = Counter(), {i: i for i in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for g in s for j in holders[g]} - {i}:
            both = len(s & sets[j])
            if 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                links[i] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    smallest = {}
    for i in sorted(rows):
        smallest.setdefault(sets[i], i)
    return {i: (smallest[sets[i]] if sets[i] else i, links[i], root(i)) for i in rows}


def corpus(near=120):
    random.seed(13)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    passage, out = text(40), []
    for i in range(150):
        w = text(random.randint(1, 60))
        out.append(w + passage if i % 3 == 0 else w)
    base = text(90)
    for _ in range(near):  # one large group of near copies
        w = list(base)
        for _ in range(random.randint(0, 2)):
            w[random.randrange(len(w))] = word()
        out.append(w)
    out += [out[5]] * 30 + [out[7] + text(2), out[7][:-1]]
    texts = [" ".join(w) for w in out] + ["", None, "...", "One two three", "one, two THREE", "x " * 9000]
    return dict(enumerate(texts))


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "c", "n", "a") for i, t in rows.items()], SCHEMA).repartition(5)
    out = jaccard.jaccard_join(df).collect()
    got = {r["row"]["doc_id"]: (r["class_id"], r["n_links"], r["group_id"]) for r in out}
    assert got == all_pairs(rows)
    firsts = Counter(r["group_id"] for r in out if r["first"])
    assert set(firsts.values()) == {1} and set(firsts) == {g for _, _, g in got.values()}


def test_equals_all_pairs(spark):
    check(spark, corpus())


def test_recursion_and_blocks_equal_all_pairs(spark, monkeypatch):
    # small limits, so that the common passage and the near copies go through every branch
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    check(spark, corpus(near=70))


def test_nulls_repeats_empty(spark):
    t = "a b c d e f g"
    rows = [(None, t), (3, t), (3, t), (3, "z y x w v u"), (None, None)]
    df = spark.createDataFrame([(i, x, "", "", "") for i, x in rows], SCHEMA)
    got = sorted((str(r["row"]["doc_id"]), str(r["row"]["text"]), str(r["class_id"]), r["n_links"], r["first"]) for r in jaccard.jaccard_join(df).collect())
    assert got == [("3", t, "3", 2, True)] * 2 + [("3", "z y x w v u", "3", 0, True), ("None", "None", "None", 0, True), ("None", t, "3", 2, False)]
    assert jaccard.jaccard_join(df.limit(0)).count() == 0


@pytest.mark.parametrize("similarity, least", [(0.8, 0.99), (0.9, 0.995)])
def test_paths_reach_the_target_recall(similarity, least):
    import numpy as np

    rng, met, runs = np.random.default_rng(0), 0, jaccard.runs_for(0.9995)
    for _ in range(400):
        n = int(rng.integers(20, 300))
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        y = x[: int(np.ceil(similarity * n))]
        met += len(np.intersect1d(jaccard.chosen_paths(x, runs), jaccard.chosen_paths(y, runs))) > 0
    assert met >= least * 400


def test_longer_paths_keep_the_target_recall(spark):
    # pairs at 0.8, one set holding the other, whose buckets stay large at every level
    from pyspark.sql import functions as F

    random.seed(29)
    rows = []
    for k in range(1000):
        w = ["".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(104)]
        rows += [(2 * k, " ".join(w), "", "", ""), (2 * k + 1, " ".join(w[:84]), "", "", "")]
    join = jaccard._Join(spark.createDataFrame(rows, SCHEMA).repartition(8), 0.8, 5, 0.97, "doc_id", "text")
    paths = join.classes.select(F.explode("paths").alias("path"), "node")
    held = join.texts(join.classes.select("node"))
    for _ in range(jaccard.MORE_DEPTH):
        paths = join.longer(paths, held)
    met = paths.groupBy("path", F.expr("node.id div 2").alias("pair")).agg(F.countDistinct("node").alias("n")).where("n > 1")
    assert met.select("pair").distinct().count() >= 970
    assert 1 - (1 - jaccard.run_recall()) ** jaccard.runs_for(0.9995) >= 0.9995


def test_split_and_runs_follow_the_threshold(spark):
    # at 0.6 two linked sets may lie on both sides of the bounds for 0.8: here 0.71 and 0.46 from the pivot
    words = lambda *parts: " ".join(f"{c}{k}" for c, n in parts for k in range(n))
    rows = [(0, words(("p", 100)), "", "", ""), (1, words(("p", 85), ("e", 20)), "", "", ""), (2, words(("p", 60), ("e", 20), ("f", 10)), "", "", "")]
    join = jaccard._Join(spark.createDataFrame(rows, SCHEMA), 0.6, 1, 0.9995, "doc_id", "text")
    large = join.classes.selectExpr("1L as path", "first(node) over (order by node.id rows between unbounded preceding and unbounded following) as pivot", "node", "3L as members")
    core, rest = ({r["node"]["id"] for r in side.collect()} for side in join.split(large, join.texts(join.classes.select("node"))))
    assert {1, 2} <= core or {1, 2} <= rest
    assert 1 - (1 - jaccard.run_recall(0.6)) ** join.runs >= 0.9995
    with pytest.raises(ValueError):
        jaccard.jaccard_join(spark.createDataFrame(rows, SCHEMA), threshold=0.0)
