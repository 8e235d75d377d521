"""Operators 2 and 5 against brute force."""

import random
import sys

import numpy as np
import pytest
from dwspark.llm import spans

SCHEMA = "doc_id long, text string, key string, row string, covered string, n_units string"


def brute(rows, units, runs_of):
    """rows: {doc_id: text}; plain scan in order of doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows.items()):
        own = units(text) if text else []
        gone = set()
        for first, n, content in runs_of(text, own) if text else []:
            if content in seen:
                gone |= set(range(first, first + n))
            seen.add(content)
        kept = "".join(text[a:b] for i, (a, b) in enumerate(own) if i not in gone) if gone else text
        if gone and len(own) - 1 in gone:
            kept = kept.removesuffix("\n")
        out[doc_id] = (kept, len(own), len(gone))
    return out


def line_content(text, own, size=3):
    lines = text.split("\n")
    return [(i, size, tuple(lines[i : i + size])) for i in range(len(lines) - size + 1) if "".join(lines[i : i + size]).strip()]


def sentence_content(text, own, size=3, least=12):
    ws = [text[a:b].split() for a, b in own]
    out = []
    for i in range(len(own)):
        for e in range(i + size, len(own) + 1):
            if sum(map(len, ws[i:e])) >= least:
                out.append((i, e - i, tuple(" ".join(w) for w in ws[i:e])))
                break
    return out


CASES = [(spans.dedup_lines, spans.line_units, line_content), (spans.dedup_sentences, spans.sentence_units, sentence_content)]


@pytest.mark.parametrize("op, units, content", CASES)
def test_equals_brute_force(spark, op, units, content):
    random.seed(3)
    passage = "\n".join(f"This is line {i} of a passage. It has words, many of them! " for i in range(5))
    texts = []
    for i in range(120):
        lines = [" ".join(random.choice("ab cd ef gh ij kl mn".split()) for _ in range(random.randint(0, 9))) + random.choice([".", "", "!"]) for _ in range(random.randint(0, 8))]
        if i % 3 == 0:
            lines.insert(random.randint(0, len(lines)), passage)
        texts.append("\n".join(lines))
    texts += [texts[0], "", None, "same\n" * 50, "x " * 5000, ". ." * 500, "one\ntwo", "one\ntwo"]
    rows = dict(enumerate(texts))
    df = spark.createDataFrame([(i, t, "k", "r", "c", "u") for i, t in rows.items()], SCHEMA).repartition(7)
    got = {r["row"]["doc_id"]: (r["text"], r["n_units"], r["n_removed"]) for r in op(df).collect()}
    assert got == brute(rows, units, content)
    assert sum(n for _, _, n in got.values()) > 100


@pytest.mark.parametrize("op, units, content", CASES)
def test_nulls_repeats_empty(spark, op, units, content):
    text = "a b c d e f.\ng h i j k l.\nm n o p q r.\ns."
    rows = [(None, text, "", "", "", ""), (5, text, "", "", "", ""), (5, text, "", "", "", ""), (6, None, "", "", "", "")]
    got = sorted((r["row"]["doc_id"] or 0, r["n_removed"]) for r in op(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0), (5, 4), (5, 4), (6, 0)]
    assert op(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_sentences_are_cut_alike_wherever_they_stand():
    passage = " ".join(f"word{i}" for i in range(60))
    a, b = (text := "x y " + passage + " z. Q"), (other := "Something else entirely, " + passage)
    cut = [[t[s:e].strip() for s, e in spans.sentence_units(t)] for t in (a, b)]
    assert text == "".join(text[s:e] for s, e in spans.sentence_units(text)) and other
    assert len(set(cut[0]) & set(cut[1])) >= 4


def test_hash_of_a_run_depends_on_its_sentences_alone():
    tail = "One two three four. Five six seven eight. Nine ten eleven twelve. End."
    runs = [spans.sentence_runs(t, spans.sentence_units(t), 3, 12) for t in (tail, "Zero. " * 40 + tail)]
    assert (runs[0][2][0] == runs[1][2][-2]).all() or any((h == runs[0][2][0]).all() for h in runs[1][2])
    assert len(np.unique(runs[0][2], axis=0)) == len(runs[0][2])


def test_runs_of_several_texts_are_those_of_each():
    random.seed(5)
    texts = ["".join(random.choice(["a ", "b\u3000", ". ", "!\n", "\x85", "\u00e9 word "]) for _ in range(random.randint(0, 90))) for _ in range(80)]
    of, *rest = spans.runs_of_words([spans.sentence_words(t) for t in texts], 3, 12)
    alone = [spans.sentence_runs(t, spans.sentence_units(t), 3, 12) for t in texts]
    assert of.tolist() == [i for i, (first, _, _) in enumerate(alone) for _ in first] and len(of) > 500
    for got, want in zip(rest, zip(*alone)):
        assert (got == np.concatenate(want)).all()
    assert [spans.sentence_count(t) for t in texts] == [len(spans.sentence_units(t)) for t in texts] == [len(spans.sentence_words(t)[1]) for t in texts]
    assert spans.sentence_units("  " + "w " * 20)[0][0] == 0


def test_a_sentence_costs_few_calls():
    text, calls = "One two three four five. " * 1000, 0

    def seen(frame, event, arg):
        nonlocal calls
        calls += event in ("c_call", "call")

    sys.setprofile(seen)
    try:
        spans.runs_of_words([spans.sentence_words(text)], 3, 12)
    finally:
        sys.setprofile(None)
    assert calls < 8 * 1000  # nine before, two of them splits
