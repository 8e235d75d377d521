"""Operator 6: vector best-fit packing of token sequences.

A document is its token ids and an end id. One longer than ``max_tokens`` is
cut into pieces of ``max_tokens``; only its first piece may be shorter. Pieces
are vectors (tokens, documents, attention cost = tokens squared). A bin is a
training sequence with a capacity in each dimension. In order of falling
length, a piece goes to the open bin that fits it in every dimension and has
the best score:

* ``norm``: the smallest weighted norm of the capacities that would be left;
* ``dot``: the largest weighted dot product of the piece and what is left.

Spark deals the pieces (a few numbers each, no ids unless asked for) evenly by
hash into shards of about ``shard_pieces``, and each shard is packed alone; at
most about one sequence a shard is left part empty.

Defined cases: null text is empty (the document is just its end id); an empty
table gives an empty result; repeated rows and ids are packed as often as they
come; other columns are ignored. Special strings inside a text become their
ids, as is the tokenizer's default.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.common import shuffle_parts, written

SHARD_PIECES = 8_192
END_ID = 2
SPECIAL = {"<|endoftext|>": 50256}  # fixed value of the tokenizer file
# Both libraries split these alike (tested); other texts go to the slower one.
_BEYOND = re.compile("[\U00020000-\U0010ffff]")
_STATE: dict = {}


def encoder(json_path: str, ranks_path: str, pattern: str):
    """Function text -> ids, equal to the tokenizer of ``json_path``.

    ``ranks_path`` holds the same vocabulary for the faster library.
    """
    key = (json_path, ranks_path, pattern)
    if _STATE.get("key") != key:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
        slow = Tokenizer.from_file(json_path)

        def encode(text: str) -> np.ndarray:
            if not _BEYOND.search(text):
                try:
                    return np.asarray(fast.encode(text, allowed_special="all"), dtype="<u4")
                except Exception:  # its pattern engine gives up on some very long runs of blanks
                    pass
            return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

        _STATE.update(key=key, encode=encode)
    return _STATE["encode"]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter."""
    first = n % size
    starts = ([0] if first else []) + list(range(first, n, size))
    return [(s, first if first and s == 0 else size) for s in starts]


def pieces(docs: DataFrame, tokenizer: tuple[str, str, str], max_tokens: int, with_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32 and, if asked for, the ids as little-endian bytes."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*tokenizer)
        for batch in got:
            rows, of = [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(END_ID)).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), max_tokens)):
                    raw = ids[start : start + n].tobytes()
                    of.append(i)
                    rows.append((k, start, n, zlib.crc32(raw), raw if with_ids else b""))
            if rows:
                k, start, n, crc, raw = zip(*rows)
                out = {"doc_id": batch.column(0).take(pa.array(of)), "piece": pa.array(k, pa.int32()), "start": pa.array(start, pa.int64())}
                out |= {"length": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                yield pa.record_batch(out | ({"ids": pa.array(raw, pa.binary())} if with_ids else {}))

    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. ``lengths`` fall; a piece that is too large for an empty bin gets one alone."""
    cap = np.asarray(capacity, dtype=np.float64)
    w = np.asarray(weights, dtype=np.float64)
    n = len(lengths)
    bins = np.empty(n, dtype=np.int64)
    offsets = np.zeros(n, dtype=np.int64)
    left = np.empty((256, 3))  # open bins only: what is left in units of the capacity
    used = np.empty(256, dtype=np.int64)  # tokens in the bin
    ids = np.empty(256, dtype=np.int64)
    opened = count = 0
    least = (lengths.min() if n else 0) / cap[0]
    for i, length in enumerate(lengths.tolist()):
        item = np.array([length, 1.0, float(length) * length]) / cap
        at = -1
        if opened:
            rest = left[:opened] - item
            fits = (rest >= -1e-12).all(axis=1)
            if fits.any():
                score = (rest * rest) @ w if rule == "norm" else -(left[:opened] * item) @ w
                at = int(np.argmin(np.where(fits, score, np.inf)))
        if at < 0:
            if opened == len(left):
                left, used, ids = np.vstack([left, left]), np.append(used, used), np.append(ids, ids)
            at = opened
            left[at], used[at], ids[at] = 1.0, 0, count
            opened += 1
            count += 1
        bins[i], offsets[i] = ids[at], used[at]
        left[at] -= item
        used[at] += length
        if left[at, 0] < least - 1e-12 or left[at, 1] < 1 / cap[1] - 1e-12 or left[at, 2] <= 0:
            opened -= 1  # full: the last open bin takes its row
            left[at], used[at], ids[at] = left[opened], used[opened], ids[opened]
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: tuple[str, str, str],
    max_tokens: int = 1024,
    max_docs: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.1),
    rule: str = "norm",
    with_ids: bool = True,
    shard_pieces: int = SHARD_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids as bytes).

    ``tokenizer``: the .json file, the rank file of the same vocabulary, the
    pattern of the rank file. ``max_docs`` defaults to ``max_tokens`` pieces and
    ``max_attention`` (sum of squared lengths) to ``max_tokens`` squared: bounds
    that never cost a sequence. Lower values bind.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule is norm or dot, not {rule!r}")
    spark = docs.sparkSession
    capacity = (max_tokens, max_docs or max_tokens, max_attention or max_tokens**2)
    cutted = pieces(docs, tokenizer, max_tokens, with_ids, id_col, text_col)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in cutted.schema.fields]
    # a number written with each piece, so that even pieces that are equal in all else are dealt to all shards
    cutted = written(cutted.withColumn("nth", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-cutted.count() // shard_pieces))
    dealt = cutted.withColumn("shard", F.pmod(F.xxhash64("nth", "ids_crc32"), F.lit(shards))).drop("nth")

    def run(shard: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")]
        shard = shard.sort_by(order)
        bins, offsets = best_fit(shard["length"].to_numpy(), capacity, weights, rule)
        ids = bins + (shard["shard"][0].as_py() << 32)
        return shard.drop_columns(["shard"]).append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.repartition(max(shards, shuffle_parts(spark)), "shard").groupBy("shard").applyInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))
