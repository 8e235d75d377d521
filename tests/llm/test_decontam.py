"""Operator 3 against plain scanning."""

import random

import numpy as np
from dwspark.llm import decontam
from dwspark.llm.fm_index import FmIndex, suffix_array

DOC = "doc_id long, text string, items string, spans string"


def texts_and_items():
    random.seed(11)
    vocabulary = "the of a-b Ünï x1 99 Tea cup long été 漢字 don't".split()
    make = lambda n: random.choice([" ", ", ", "\n"]).join(random.choice(vocabulary) for _ in range(n))
    items = {f"i{k}": make(random.choice([1, 4, 13, 14, 30])) for k in range(25)} | {"none": "", "null": None}
    docs = [make(random.randint(0, 60)) for _ in range(80)]
    docs += [f"{make(5)} {items['i3'].upper()} {make(9)}" for _ in range(20)]
    docs += [docs[0]] * 5 + ["", None, "the " * 400, items["i5"], "\U0001f600 " + items["i7"] + "."]
    return docs, items


def test_equals_plain_scanning(spark):
    docs, items = texts_and_items()
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(docs)], DOC).repartition(3)
    bench = spark.createDataFrame([(k, v, "z") for k, v in items.items()], "item_id string, text string, row string")
    for kw in ({"window": 13}, {"window": 5, "shard_words": 60, "block_bytes": 300}):
        got = {r["row"]["doc_id"]: r for r in decontam.decontaminate(df, bench, **kw).collect()}
        assert len(got) == len(docs)
        for i, t in enumerate(docs):
            r = got[i]
            assert (r["n_words"], r["n_hit"], r["items"]) == decontam.brute_force(t, items, kw["window"])
            assert r["text"] == t and sum(len(decontam.words(t[s["start"] : s["end"]])) for s in r["spans"]) == r["n_hit"]


def test_few_blocks_are_alive_at_once(spark):
    docs = spark.createDataFrame([(i, f"x w{i} y z", "", "") for i in range(20)], DOC)
    bench = spark.createDataFrame([(str(i), f"w{i}") for i in range(20)], "item_id string, text string")
    out = decontam.decontaminate(docs, bench, block_bytes=4)  # 50 bytes: 13 blocks
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 4
    assert {r["row"]["doc_id"]: (r["n_hit"], r["items"]) for r in out.collect()} == {i: (1, [str(i)]) for i in range(20)}


def test_nulls_repeats_empty(spark):
    df = spark.createDataFrame([(None, "a b", "", ""), (1, "a b", "", ""), (1, "a b", "", "")], DOC)
    bench = spark.createDataFrame([(None, "A"), ("k", None)], "item_id string, text string")
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in decontam.decontaminate(df, bench).collect()] == [(2, 1, [""])] * 3
    assert decontam.decontaminate(df.limit(0), bench).count() == 0
    assert [r["n_hit"] for r in decontam.decontaminate(df, bench.limit(0)).collect()] == [0, 0, 0]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 4, rng.integers(0, 200)) for _ in range(12)]
    docs += [docs[0], docs[0], np.ones(500, dtype=int)]
    symbols = np.concatenate([np.append(d, 0) for d in docs])
    separators = np.cumsum([len(d) + 1 for d in docs]) - 1
    index = FmIndex(symbols, separators)
    for p in ([1], [1, 2], [3, 3, 1, 2], [1] * 9, [2, 1, 3, 2, 2, 1]):
        start, end = index.search(np.array([p]), np.array([len(p)]))
        got = sorted(index.locate(np.arange(start[0], end[0])))
        assert got == [i for i in range(len(symbols) - len(p) + 1) if symbols[i : i + len(p)].tolist() == p]
    unique = symbols + len(separators)
    unique[separators] = np.arange(len(separators))
    assert suffix_array(unique).tolist() == sorted(range(len(unique)), key=lambda i: unique[i:].tolist())
