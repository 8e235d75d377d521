"""Operator 6 against the tokenizer library and its own constraints."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from dwspark.llm import packing
from tokenizers import Tokenizer

TOK = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
SCHEMA = "doc_id long, text string, piece string, shard string, sequence_id string"


def run(spark, texts, **kw):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    return packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(3), TOK, **kw).collect()


def bins_of(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
    return bins


def test_ids_pieces_and_offsets(spark):
    texts = ["", None, "a b", "<|endoftext|>x", "word " * 700, "é漢\U0001f600\U00020000 " * 90, " " * 5000, "x" * 3000, "a\n\n b" * 300]
    rows = run(spark, texts, max_tokens=64)
    tok = Tokenizer.from_file(TOK[0])
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and all(r["length"] == 64 for r in mine[1:])
        for r in mine:
            want = np.asarray(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert bytes(r["ids"]) == want and r["ids_crc32"] == zlib.crc32(want)
        assert sum(r["length"] for r in mine) == len(ids)
    assert all(sum(n for _, n in b) <= 64 for b in bins_of(rows).values())


def test_every_constraint_binds_and_few_sequences(spark):
    texts = ["w " * (i % 40) for i in range(600)]
    rows = run(spark, texts, max_tokens=128)
    total = sum(r["length"] for r in rows)
    assert len(bins_of(rows)) <= 1.03 * total / 128 + 1
    for rule in ("norm", "dot"):
        bins = bins_of(run(spark, texts, max_tokens=128, max_docs=3, max_attention=4000.0, rule=rule))
        assert all(len(b) <= 3 and (len(b) == 1 or sum(n * n for _, n in b) <= 4000) for b in bins.values())


def test_repeats_nulls_empty(spark):
    rows = [(None, "a", "", "", ""), (1, "a", "", "", ""), (1, "a", "", "", "")]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), TOK).collect()
    assert len(got) == 3 and len(bins_of(got)) == 1
    assert packing.pack(spark.createDataFrame([], SCHEMA), TOK).count() == 0


def test_equal_rows_are_dealt_to_all_shards(spark):
    # a third of all rows is one row, with a null id
    rows = [(None, "one and the same text", "", "", "")] * 400 + [(i, f"text number {i} " * (i % 5 + 1), "", "", "") for i in range(800)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(4), TOK, max_tokens=64, shard_pieces=100).collect()
    assert len(got) == 1200
    bins_of(got)
    shards = [r["sequence_id"] >> 32 for r in got if r["doc_id"] is None]
    assert len(set(shards)) == 12 and max(shards.count(s) for s in set(shards)) < 80
