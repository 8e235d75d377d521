"""Operator 7: the automaton against edit distances, the model on held-out documents."""

import random
import zlib

from dwspark.llm import toxicity
from dwspark.llm.automaton import EXACT, FUZZY, STEM, LexiconAutomaton, allowed_edits


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distances():
    random.seed(7)
    terms, stems = ["idiot", "moron", "scum", "worthless", "idiom"], ["vequ"]
    auto = LexiconAutomaton(terms, stems)
    words = ["", "vequille", "veq", "idiot", "scum", "scun", "w0rthl3ss", "漢字"]
    for _ in range(3000):
        w = list(random.choice(terms))
        for _ in range(random.randint(0, 3)):
            at = random.randint(0, len(w))
            w[at : at + random.randint(0, 1)] = random.choice(["", "a", "o", "x", "é"])
        words.append("".join(w))
    for w in words:
        got = auto.match(w)
        if w.startswith("vequ"):
            assert got == (STEM, "vequ")
        elif w in terms:
            assert got == (EXACT, w)
        else:
            near = {t: distance(w, t) for t in terms if distance(w, t) <= allowed_edits(t)}
            assert (got is None) == (not near)
            assert got is None or got == (FUZZY, min(near, key=lambda t: (near[t], t)))


def corpus(seed):
    random.seed(seed)
    syllables = "th er on an re nd ha en st ti".split()
    word = lambda: "".join(random.choice(syllables) for _ in range(random.randint(1, 3)))
    docs, labels = [], []
    for i in range(900):
        w = [word() for _ in range(random.randint(5, 40))]
        toxic = i % 5 == 0
        for _ in range(random.randint(1, 4) if toxic else 0):
            w.insert(random.randint(0, len(w)), random.choice(["grumbler", "vilekind", "zorp" + random.choice("aeiou") + word()]))
        docs.append((i, " ".join(w), "x", 0.5))
        labels.append((i, 1, int(toxic)))
    return docs, labels


DOC = "doc_id long, text string, row string, score double"


def test_held_out_documents_misspellings_and_quotations(spark):
    docs, labels = corpus(1)
    d, lab = spark.createDataFrame(docs, DOC).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    # labels of held-out rows are never learnt from
    flipped = lab.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    model = toxicity.fit(d, flipped)
    assert model == toxicity.fit(d, lab) and {"grumbler", "vilekind"} <= set(model.terms) and any(s.startswith("zorp") for s in model.stems)
    got = {r["row"]["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    wrong = [(i, docs[i][1], got[i]) for i in held if (got[i] >= toxicity.THRESHOLD) != (i % 5 == 0)]
    assert not wrong
    extra = ["grumblr th er", 'he said "grumbler" there', "zorpa" + "th", "", None, "th " * 20_000 + "gruumbler"]
    rows = toxicity.score(spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(extra)], DOC), model).collect()
    flags = [r["score"] >= toxicity.THRESHOLD for r in sorted(rows, key=lambda r: r["row"]["doc_id"])]
    assert flags == [True, False, True, False, False, True]


def test_nulls_repeats_empty(spark):
    d = spark.createDataFrame([(None, "a", "", 0.0), (1, None, "", 0.0), (1, "a", "", 0.0), (1, "a", "", 0.0)], DOC)
    lab = spark.createDataFrame([(None, 1, 1), (1, 1, None), (0, 1, 1), (0, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(d, lab)
    assert model == toxicity.Model()
    assert len({r["score"] for r in toxicity.score(d, model).collect()}) == 1
    assert toxicity.score(d.limit(0), model).count() == 0 and toxicity.fit(d.limit(0), lab.limit(0)) == toxicity.Model()


def test_repeated_stems_need_more_words_than_chance_explains():
    model = toxicity.Model(repeated={"vequ": 1e-3})
    matcher = toxicity.Matcher(model)
    assert matcher.counts("vequa b c") == (0, 0, 0)  # one alone may be chance
    assert matcher.counts("vequa b vequa c") == (0, 0, 0)  # the same word again
    assert matcher.counts("vequa b vequo c vequi") == (3, 0, 0)
    long = " ".join(f"w{i}" for i in range(5000))
    assert matcher.counts(f"{long} vequa vequo vequi") == (0, 0, 0)  # as many as a clean text of that length holds
    assert matcher.counts(None) == (0, 0, 0)
    for k, mean in ((0, 1.0), (3, 0.5), (5, 20.0), (900, 800.0), (2000, 800.0)):
        assert 0 <= toxicity.poisson_tail(k, mean) <= 1


def test_weights_of_abuse_are_never_negative():
    w = toxicity.fit_weights([((0, 0, 0), 900.0, 10.0), ((0, 2, 0), 500.0, 0.0), ((3, 0, 0), 0.0, 90.0)])
    assert w[1] > 0 and w[2] >= 0 and w[3] >= 0


def test_planted_misspellings_and_quotations(spark):
    """Learnt from given documents; words planted in clean held-out ones."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    matcher = toxicity.Matcher(model)
    held = labels.where((toxicity.remainder(labels.doc_id) == 1) & (labels.toxic == 0)).select("doc_id")
    texts = [r["text"] or "" for r in docs.join(held, "doc_id").select("text").collect()]
    texts = [t for t in texts if matcher.counts(t) == (0, 0, 0) and len(t.split(" ")) >= 20][:300]
    assert len(texts) == 300
    terms = [t for t in model.terms if len(t) >= 5]
    random.seed(11)

    def misspelt(w):
        at = random.randrange(1, len(w))
        return w[:at] + random.choice(["", "y", "0", w[at] * 2]) + w[at + 1 :]

    def caught(put):
        n = 0
        for t in texts:
            words = t.split(" ")
            for _ in range(2):
                words.insert(random.randrange(len(words)), put(random.choice(terms)))
            n += model.score(matcher.counts(" ".join(words))) >= toxicity.THRESHOLD
        return n

    assert caught(lambda w: w) >= 295 and caught(misspelt) >= 280
    assert caught(lambda w: f'"{w}"') <= 10 and caught(lambda w: f"she said {w}") <= 10
