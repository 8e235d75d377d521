"""Operator 4: token counts by a two-tier length lookup.

Tier one is a broadcast table {pre-token: number of tokens} of the frequent
pre-tokens. Every task finds its own heavy hitters with a Misra-Gries summary
over all its texts; the summaries (bounded size each) are merged in a tree.
Nothing is shuffled but these summaries: pre-tokens never are.
Tier two is a cache in each Python worker: a pre-token that the broadcast
table lacks is encoded once by the tokenizer library and remembered.
The table only saves time; the counts do not depend on it.
No pre-token, special string or composed character crosses a blank. So in a
text with characters outside ``PLAIN`` (emoji, no-break space, most scripts
but Latin, Greek, Cyrillic, Han, kana and Hangul, and some letters of these)
only the pieces between blanks that hold one go past the pre-token pattern:
such a piece is looked up in the worker's cache, and encoded by the library,
as it is.

Defined cases: a null text is the empty text (0 bytes, 0 tokens); repeated
rows and repeated ids give one row each; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY_SIZE = 8_192  # counters that a Misra-Gries summary keeps
TABLE_SIZE = 32_768  # pre-tokens in the broadcast table at most (about 2 MB)
CACHE_SIZE = 300_000  # pre-tokens that a worker remembers; then it starts anew
FAN_IN = 64  # summaries merged by one task
BATCH_CHARS = 1 << 20

# Fixed values of the tokenizer file: its pre-token pattern and special strings.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIALS = ("<|startoftext|>", "<|endoftext|>")
PIECE_CHARS = 64  # longer pieces are not remembered
# Code points whose classes and case every library version agrees on; pieces with others go to the tokenizer as they are.
PLAIN = "[\t\n\r\x20-\x7e¡-įĲ-ňŊ-žΑ-Ρα-ρА-я–—‘-”…€、。「」ぁ-ゔァ-ヺー一-龥가-힣]*"
BLANKS = "[\t\n\r ]+"

_STATE: dict = {}


def _tools(path: str) -> dict:
    """Per worker process: the tokenizer, the compiled patterns and the cache."""
    if _STATE.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import re

        import regex
        from tokenizers import Tokenizer

        _STATE.update(
            path=path, tok=Tokenizer.from_file(path), pre=regex.compile(PRETOKEN), cache={},
            plain=re.compile(PLAIN), blanks=re.compile(BLANKS), special=re.compile("|".join(map(re.escape, SPECIALS))),
        )
    return _STATE


def pretokens(text: str, s: dict) -> list[str]:
    """Pre-tokens of a text without special strings, as the tokenizer's normalizer and splitter give them."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return s["pre"].findall(text.lower())


def lookups(text: str, s: dict) -> list[str]:
    """What of a text without special strings is looked up: pre-tokens, and pieces with other characters than ``PLAIN``."""
    plain = s["plain"].fullmatch
    if plain(text):
        return pretokens(text, s)
    clear, other = [], []
    for piece in s["blanks"].split(text):
        (clear if plain(piece) else other).append(piece)
    return pretokens(" ".join(clear), s) + other


def count_tokens(texts: list[str], path: str, frequent: dict[str, int]) -> list[int]:
    """Number of tokens of each text."""
    s = _tools(path)
    cache: dict[str, int] = s["cache"]
    out = [0] * len(texts)
    split: list[tuple[int, list[str]]] = []
    for i, t in enumerate(texts):
        parts = s["special"].split(t) if "<|" in t else [t]
        out[i] = len(parts) - 1
        split += [(i, lookups(p, s)) for p in parts if p]
    missing = {p for _, ps in split for p in ps if p not in frequent and p not in cache}
    if missing:
        if len(cache) + len(missing) > CACHE_SIZE:
            cache.clear()
            missing = {p for _, ps in split for p in ps if p not in frequent}
        new = list(missing)
        for a in range(0, len(new), 8192):
            part = new[a : a + 8192]
            for p, e in zip(part, s["tok"].encode_batch(part, add_special_tokens=False)):
                cache[p] = len(e.ids)
    for i, ps in split:
        for p, n in Counter(ps).items():
            out[i] += n * (frequent[p] if p in frequent else cache[p])
    for p in missing:
        if len(p) > PIECE_CHARS:
            del cache[p]
    return out


def _shrink(c: Counter, size: int) -> Counter:
    """Misra-Gries: with more than ``size`` keys, take the next largest count off all."""
    if len(c) <= size:
        return c
    cut = sorted(c.values(), reverse=True)[size]
    return Counter({k: v - cut for k, v in c.items() if v > cut})


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about BATCH_CHARS characters each."""
    start = size = 0
    for i, n in enumerate(lengths):
        size += n
        if size >= BATCH_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of parts of a batch, so that few texts are Python strings at a time."""
    column = batch.column(batch.schema.get_field_index("text"))
    for a, b in _slices(pc.utf8_length(column).to_pylist()):
        yield a, column.slice(a, b - a).to_pylist()


def frequent_pretokens(texts: DataFrame, path: str, summary_size: int = SUMMARY_SIZE, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """The heavy hitters among all pre-tokens of column ``text`` with their token counts, at most ``table_size``."""

    def row(total: Counter) -> Iterator[pa.RecordBatch]:
        if total:
            yield pa.record_batch({"pre": pa.array([list(total)], pa.list_(pa.string())), "n": pa.array([list(total.values())], pa.list_(pa.int64()))})

    def summarise(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, total = _tools(path), Counter()
        for batch in got:
            for _, texts in _texts(batch):
                for t in texts:
                    total.update(p for p in lookups(t, s) if len(p) <= PIECE_CHARS)
                if len(total) > 8 * summary_size:
                    total = _shrink(total, summary_size)
        yield from row(_shrink(total, summary_size))

    def merge(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in got:
            for pre, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update(dict(zip(pre, n)))
                total = _shrink(total, summary_size)
        yield from row(total)

    schema = "pre array<string>, n array<long>"
    parts = texts.rdd.getNumPartitions()
    found = texts.select("text").mapInArrow(summarise, schema)
    while parts > 1:  # a tree of merges down to one summary
        parts = -(-parts // FAN_IN)
        found = found.repartition(parts).mapInArrow(merge, schema)
    total = Counter()
    for r in found.collect():  # one row of at most summary_size pre-tokens
        total = _shrink(total + Counter(dict(zip(r["pre"], r["n"]))), table_size)
    s = _tools(path)
    top = list(total)
    encoded = s["tok"].encode_batch(top, add_special_tokens=False) if top else []
    return {p: len(e.ids) for p, e in zip(top, encoded)}


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``path``: the tokenizer file. See the module's docstring for the method.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_pretokens(texts, path))

    def count(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            for a, part in _texts(batch):
                ids, sizes = (batch.column(c).slice(a, len(part)) for c in (0, 2))
                yield pa.record_batch({"doc_id": ids, "n_bytes": sizes, "n_tokens": pa.array(count_tokens(part, path, frequent.value), pa.int64())})

    counted = texts.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
