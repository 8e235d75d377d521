"""Operator 11 against scoring every pair, and its defined cases."""

import math
import random
import re
from collections import Counter

from dwspark.llm import ranked as R

DOCS = "doc_id long, text string, item string, doc string, rank string"
ITEMS = "item_id {}, text string, term string"


def brute_force(docs, items, k):
    def terms(text):
        return re.findall(R.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    read = [(d, Counter(terms(t))) for d, t in docs]
    read = [(d, c) for d, c in read if c]
    n_docs, total = len(read), sum(c.total() for _, c in read)
    df = Counter(t for _, c in read for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in asked.items():
        found = []
        for d, c in read:
            m = 100 - 25 + (25 * c.total() * n_docs) // total
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in want.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, n, f[3], -f[0]) for n, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def result(spark, docs, items, id_type="long", **kw):
    d = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], DOCS).repartition(5)
    i = spark.createDataFrame([(*r, "x") for r in items], ITEMS.format(id_type))
    return sorted((tuple(r) for r in R.search(d, i, **kw).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "a1", "é", "漢", "ok", "x-y", "THE_end", "\U0001f600", "ab c", "Ünd"] + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(200)]
    docs += [(None, "the é w1"), (None, "the é w1"), (7, "the é w1"), (7, "the é w1"), (300, None), (301, ""), (302, " .,"), (303, "w3 " * 20000), (-4, "the é w1")]
    items = [(i, text(rng.randint(1, 12))) for i in range(25)] + [(3, "the the"), (None, "é"), (None, "W1 é"), (50, None), (51, ""), (52, "nowhere"), (53, "w3 w3 w3")]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus(3)
    want = brute_force(docs, items, 20)
    assert result(spark, docs, items) == want
    # blocks of a few items, each with its own pass
    assert result(spark, docs, items, block_postings=40) == want


def test_small_heaps_keep_ties_by_id(spark):
    docs = [(d, "the w1") for d in (9, 3, None, 3, 12, -1)] + [(d, "other") for d in range(20, 40)]
    items = [("q", "w1"), ("r", "the the")]
    got = result(spark, docs, items, id_type="string", k=3)
    assert got == brute_force(docs, items, 3)
    assert [g[2] for g in got if g[0] == "q"] == [-1, 3, 3]


def test_empty_tables(spark):
    assert result(spark, [], [(1, "a")]) == []
    assert result(spark, [(1, "a")], []) == []
    assert result(spark, [(1, None)], [(1, None)]) == []
