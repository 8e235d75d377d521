"""Operator 1 against Python's re, and what it learns."""

import random
import re

from dwspark.llm import pii

SCHEMA = "doc_id long, text string, spans string, base string"
# the contract's patterns as they are given
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x - 9 if x > 9 else x for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def expected(text):
    out = []
    for order, (kind, pattern) in enumerate(GIVEN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), order, m.end(), kind, m.group()))
    return sorted(out)


def test_base_spans_equal_the_given_patterns(spark):
    random.seed(17)
    parts = ["a.b%x@d.e", "@", "mail@x-y.co.uk", "1.2.3.4", ".5.6.7.8", "256.1.1.1", "007.08.9.255", "4111 1111-1111 1111", "4111111111111111", "5", "-", " ", "+", "+1 (988) 555-2485", "+49 30 123456", "é", "漢", "\U0001f600", ".", "\n", "x", "((", "0000", "79927398713", "token=", "a1b2c3d4e5f6"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(4000)]
    texts += ["", None, "9" * 30_000, "a" * 50_000 + "@", "1." * 20_000, "+1" + "(" * 20_000, "1 2-" * 10_000, "x@y.z " * 3_000, "+1234567890 " * 500]
    df = spark.createDataFrame([(i, t, "s", "b") for i, t in enumerate(texts)], SCHEMA).repartition(8)
    for r in pii.find_pii(df, weights={}).collect():
        assert [tuple(s) for s in r["base"]] == expected(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert r["spans"] == r["base"]


def test_votes_are_learnt_and_base_spans_stay(spark):
    random.seed(18)
    hexes = lambda n: "".join(random.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(random.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(15)) + "7"
    texts = []
    for i in range(400):
        texts.append([f"und password={hexes(17)}a1 so", f'the token = "{hexes(38)}b2"', f"key {key()} of", f"see chapter{i} or mail{i}room and version2024b", "write to a@b.org", "call (988) 555-2485 now"][i % 6])
    weights = pii.learn(spark.createDataFrame([(i, t, "s", "b") for i, t in enumerate(texts)], SCHEMA))
    fresh = [f"a password={hexes(18)}c3 z", f"x {key()} y", "chapter7777 is long", "mail a@b.org, tel: (212) 555-0188.", None, f"pass {hexes(40)}9a."]
    got = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame([(i, t, "s", "b") for i, t in enumerate(fresh)], SCHEMA), weights).collect()}
    kinds = [[s["kind"] for s in got[i]["spans"]] for i in range(len(fresh))]
    assert kinds == [["secret"], ["secret"], [], ["email", "phone"], [], ["secret"]]
    for i, t in enumerate(fresh):
        assert all(t[s["start"] : s["end"]] == s["value"] for s in got[i]["spans"]) and all(b in got[i]["spans"] for b in got[i]["base"])


def test_em_finds_reliable_labelers():
    random.seed(19)
    patterns, truth = {}, {}
    for _ in range(20_000):
        y = random.random() < 0.3
        v = tuple((1 if (random.random() < right) == y else -1) if random.random() < 0.8 else 0 for right in (0.95, 0.85, 0.7, 0.6, 0.9))
        patterns[v] = patterns.get(v, 0) + 1
        truth[v] = truth.get(v, 0) + y
    p = pii.em(patterns)
    assert sum(patterns[v] * abs((p[v] >= 0.5) - truth[v] / patterns[v]) for v in patterns) / 20_000 < 0.06


def test_nulls_repeats_empty(spark):
    df = spark.createDataFrame([(None, "a@b.c", "", ""), (1, "a@b.c", "", ""), (1, "a@b.c", "", ""), (2, None, "", "")], SCHEMA)
    assert sorted((r["doc_id"] or 0, len(r["spans"])) for r in pii.find_pii(df).collect()) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert pii.find_pii(df.limit(0)).count() == 0
