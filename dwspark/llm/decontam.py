"""Operator 3: benchmark decontamination by FM-index.

Each Spark task cuts its documents into shards of about ``shard_words`` words
and builds an FM-index of each (see ``fm_index``). The test phrases, windows
of ``window`` consecutive words of the benchmark items (an item of fewer words
is one window), are broadcast and searched backward in the index; occurrences
are located by sampled suffix positions and merged into removal spans.
Documents are never shuffled. A benchmark of more than ``block_bytes`` is searched in
blocks of about that size. The documents are written after every
``BLOCKS_AT_ONCE`` blocks, so that only so many broadcasts and Python workers
of a task live at a time.

Words are compared by 64-bit hashes; a false hit would need such a collision
next to a run of true matches.

Defined cases: null and empty texts have no words and no hits; items without
words are in no document; repeated rows are judged one by one; an item id on
several rows is one item; other columns are ignored or passed through as they
are; empty tables on either side give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.common import words, written
from dwspark.llm.fm_index import FmIndex

SHARD_WORDS = 1 << 20
BLOCK_BYTES = 4 << 20
BLOCKS_AT_ONCE = 4

# Bytes of words: digits, letters and all bytes of non-ASCII characters; A-Z count as a-z.
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
_VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        got = np.full(size, base, dtype=np.uint64)
        got[0] = 1
        got = np.cumprod(got, dtype=np.uint64)
        if size <= 1 << 24:
            _POWERS[base] = got
    return got[:n]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the words of UTF-8 bytes. The hash depends on the word alone."""
    inside = _IS_WORD[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_VALUE[raw] * _powers(_BASE, len(raw)), dtype=np.uint64)])
    h = (sums[end] - sums[start]) * _powers(_INVERSE, len(raw) + 1)[start]
    return start, end, h ^ (h >> np.uint64(29))


class Phrases:
    """Distinct windows of a block of items, as rows of word hashes aligned to the right."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        owners: dict[tuple, set[int]] = {}
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            h = word_hashes(raw)[2].tolist()
            for k in range(max(1, len(h) - window + 1) if h else 0):
                owners.setdefault(tuple(h[k : k + window]), set()).add(number[item])
        rows = list(owners)
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.hashes = np.zeros((len(rows), window), dtype=np.uint64)
        for k, r in enumerate(rows):
            self.hashes[k, window - len(r) :] = r
        self.owner_starts = np.concatenate([[0], np.cumsum([len(owners[r]) for r in rows], dtype=np.int64)])
        self.owners = np.array([o for r in rows for o in sorted(owners[r])], dtype=np.int64)


def _expand(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for all values starts[row] .. starts[row] + sizes[row] - 1."""
    of = np.repeat(np.arange(len(starts)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def search_shard(hashes: list[np.ndarray], phrases: Phrases) -> tuple[list[np.ndarray], list[list[str]]]:
    """For each document (word hashes): marks of hit words, and the items that occur."""
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    values, numbers = np.unique(np.concatenate(hashes), return_inverse=True)
    symbols = np.zeros(int(sizes.sum()) + len(hashes), dtype=np.int64)
    separators = np.cumsum(sizes + 1) - 1
    begins = separators - sizes
    at = np.ones(len(symbols), dtype=bool)
    at[separators] = False
    symbols[at] = numbers + 1
    cover = np.zeros(len(symbols) + 1, dtype=np.int64)
    found: list[list[str]] = [[] for _ in hashes]
    # a phrase with a word that the shard lacks can't occur
    where = np.minimum(np.searchsorted(values, phrases.hashes), max(0, len(values) - 1))
    used = np.arange(phrases.hashes.shape[1]) >= phrases.hashes.shape[1] - phrases.lengths[:, None]
    known = np.flatnonzero(((values[where] == phrases.hashes) | ~used).all(axis=1)) if len(values) else []
    if len(known):
        index = FmIndex(symbols, separators)
        start, end = index.search(where[known] + 1, phrases.lengths[known])
        of, rows = _expand(start, np.maximum(end - start, 0))
        pos, phrase = index.locate(rows), known[of]
        np.add.at(cover, pos, 1)
        np.add.at(cover, pos + phrases.lengths[phrase], -1)
        doc = np.searchsorted(separators, pos)
        first = phrases.owner_starts[phrase]
        k, owner = _expand(first, phrases.owner_starts[phrase + 1] - first)
        for d, o in np.unique(np.stack([doc[k], phrases.owners[owner]]), axis=1).T.tolist():
            found[d].append(phrases.items[o])
    hit = np.cumsum(cover[:-1]) > 0
    return [hit[b : b + n] for b, n in zip(begins, sizes)], found


def _merge(marks: np.ndarray) -> np.ndarray:
    """Runs of marked words as rows (first, end)."""
    return np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8))).reshape(-1, 2)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``row`` (struct of the columns but the text), ``text``, ``n_words``, ``n_hit``, ``items`` (sorted strings), ``spans``.

    ``spans``: the removal spans as code points, end exclusive. ``benchmark``
    has ``item_id`` and ``text``.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    out = docs.select(F.struct(*rest).alias("row"), F.col(text_col).alias("text"))
    row_type = out.schema["row"].dataType.simpleString()
    span = "array<struct<start:int,end:int>>"
    out = out.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.array().cast(span).alias("hits"), F.array().cast(span).alias("spans"))
    schema = f"row {row_type}, text string, n_words long, n_hit long, items array<string>, hits {span}, spans {span}"
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def searcher(phrases):
        def pairs(runs: list[np.ndarray]) -> pa.Array:
            flat = np.concatenate(runs) if runs else np.empty((0, 2))
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            inner = pa.StructArray.from_arrays([pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1].astype(np.int32))], fields=list(pair))
            return pa.ListArray.from_arrays(pa.array(ends), inner)

        def shard(part: pa.RecordBatch, parsed: list) -> pa.RecordBatch:
            marks, found = search_shard([p[2] for p in parsed], phrases.value)
            runs, spans, items = [], [], []
            for (start, end, _, raw), m, f, old, before in zip(parsed, marks, found, part.column(5), part.column(4)):
                for s in old.as_py():
                    m[s["start"] : s["end"]] = True
                r = _merge(m)
                runs.append(r)
                if len(r):
                    point = np.cumsum((raw & 0xC0) != 0x80)  # code points up to each byte
                    spans.append(np.stack([point[start[r[:, 0]]] - 1, point[end[r[:, 1] - 1] - 1]], axis=1))
                else:
                    spans.append(r)
                items.append(sorted({*before.as_py(), *f}))
            n_words, n_hit = [len(p[2]) for p in parsed], [int((r[:, 1] - r[:, 0]).sum()) for r in runs]
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pairs(runs), pairs(spans)],
                names=["row", "text", "n_words", "n_hit", "items", "hits", "spans"],
            )

        def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in got:
                parsed, first, size = [], 0, 0
                for i, t in enumerate(batch.column(1)):
                    raw = np.frombuffer(t.as_buffer() or b"", dtype=np.uint8) if t.is_valid else np.empty(0, dtype=np.uint8)
                    parsed.append((*word_hashes(raw), raw))
                    size += len(parsed[-1][0])
                    if size >= shard_words:
                        yield shard(batch.slice(first, i + 1 - first), parsed)
                        parsed, first, size = [], i + 1, 0
                if parsed:
                    yield shard(batch.slice(first), parsed)

        return run

    live = []
    for k in range(blocks):
        if len(live) == BLOCKS_AT_ONCE:
            out = written(out, "searched")
            for b in live:
                b.unpersist()
            live = []
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        phrases = spark.sparkContext.broadcast(Phrases([(r["id"], r["text"]) for r in mine], window))
        live.append(phrases)
        out = out.mapInArrow(searcher(phrases), schema)
    return out.drop("hits")


def contaminated() -> "F.Column":
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def brute_force(text: str | None, items: dict[str, str | None], window: int = 13) -> tuple[int, int, list[str]]:
    """(n_words, n_hit, items) by plain scanning; for tests."""
    own, hit, found = words(text), set(), set()
    for item, phrase in items.items():
        w = words(phrase)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            p = w[k : k + window]
            for at in range(len(own) - len(p) + 1):
                if own[at : at + len(p)] == p:
                    hit |= set(range(at, at + len(p)))
                    found.add(item)
    return len(own), len(hit), sorted(found)
