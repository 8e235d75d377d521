"""The corpus pipeline, each stage held against brute force on its own input."""

import random

import corpus_pipeline as P
from dwspark.llm import decontam, packing
from dwspark.llm.common import written
from test_jaccard import all_pairs
from test_spans import brute, line_content
from test_toxicity import corpus

from dwspark.llm import spans

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    random.seed(23)
    docs, labels = corpus(1)
    rows = {i: t for i, t, _, _ in docs}
    word = lambda: "".join(random.choice("bcdfg") + random.choice("aeiou") for _ in range(3))
    line = lambda n=12: " ".join(word() for _ in range(n))
    block = "\n".join(line() for _ in range(4))
    items = [line(20) for _ in range(5)]
    at = 10_000
    for k in range(30):
        base = [word() for _ in range(80)]
        rows[at] = " ".join(base)
        rows[at + 1] = " ".join([*base[:-1], word()])  # near copy
        rows[at + 2] = rows[at]  # copy
        rows[at + 3] = "\n".join([line(), block, line()])  # passage
        rows[at + 4] = f"{line(30)} {items[k % 5]} {line(30)}"  # contaminated
        rows[at + 5] = block  # nothing new
        at += 10
    rows |= {at: "", at + 1: None, at + 2: "x " * 4000}
    return rows, labels, items


def test_stages(spark, tmpdir_path):
    rows, labels, items = texts()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows.items()], DOC).repartition(4)
    docs = docs.unionByName(docs.where("doc_id = 10000"))  # a repeated row
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    out, now = {}, spark.read.parquet(f"{tmpdir_path}/documents.parquet")
    for name, stage in P.STAGES:
        now = written(stage(spark, now, tmpdir_path), name)
        if name != P.STAGES[-1][0]:
            assert now.schema.simpleString() == docs.schema.simpleString()
            got = now.collect()
            out[name] = {r["doc_id"]: r["text"] for r in got}
            assert all(r["n_chars"] == len(r["text"] or "") for r in got)
    toxic = {i for i, _, t in labels if t}
    assert set(out["toxicity"]) == set(rows) - toxic
    lines = brute(out["toxicity"], spans.line_units, line_content)
    assert out["line_dedup"] == {i: t for i, (t, _, gone) in lines.items() if not gone or t.strip()}
    groups = all_pairs(out["line_dedup"])
    assert set(out["ngram_jaccard_join"]) == {g for _, _, g in groups.values()}
    assert spark.read.parquet(f"{tmpdir_path}/documents.parquet").where("doc_id = 10000").count() == 2
    bench = {str(k): t for k, t in enumerate(items)}
    clean = {i: t for i, t in out["ngram_jaccard_join"].items() for n, hit, _ in [decontam.brute_force(t, bench)] if not (hit and 20 * hit >= n)}
    assert out["decontamination"] == clean
    packed = now.collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    used = {}
    for r in packed:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 1024
    again = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in P.run(spark, tmpdir_path).collect()}
    assert again == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed}
    assert packing.END_ID == 2


def test_empty_tables(spark, tmpdir_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    assert P.run(spark, tmpdir_path).count() == 0
