"""Operators 2 and 5: removal of repeated runs of sentences or lines.

A document is a list of units (sentences or lines). Every run of consecutive
units is hashed (128 bits). A first pass counts half-hashes, combined in the
tasks, and gives a bitmap of fixed size; a second pass shuffles only the runs
that the bitmap takes for repeated (it may be wrong that way alone). On these
Spark finds exactly the runs that occur more than once and the first
occurrence of each: the smallest (doc_id, text digest, position). The other
occurrences are joined to their documents, their covered positions are merged,
and those units go.

Every removed unit stands, equal, at an earlier place; by induction its first
place is kept, so no content is lost, only repetition.

Rows that are equal in id and text are one document, and each of them gets
the same result.

Defined cases: a null text stays null and has no units; an empty text has
none that can repeat; null ids sort first; other columns come back as they
are, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.common import written

#: (start, end) of the units of a text; first unit, number of units and 128-bit hash of each of its runs.
Units = list[tuple[int, int]]
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]
#: The 128-bit hash and the number of words of each sentence of a text.
Hashed = tuple[bytes, list[int]]
#: Runs of several texts, after the number of each run's text.
RunsOf = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype="<u8")  # odd, so they have inverses
_INVERSE = np.array([pow(int(p), -1, 1 << 64) for p in _BASE], dtype="<u8")
FILTER_WORDS = 1 << 21  # 64-bit words of the broadcast bitmap: 16 MB


def line_units(text: str) -> Units:
    out, at = [], 0
    for line in text.split("\n"):
        out.append((at, at + len(line) + 1))
        at += len(line) + 1
    out[-1] = (out[-1][0], len(text))
    return out


def line_runs(text: str, units: Units, size: int) -> Runs:
    """Overlapping windows of ``size`` lines; windows of blank lines alone don't count."""
    lines = text.split("\n")
    windows = [(i, "\n".join(lines[i : i + size])) for i in range(len(lines) - size + 1)]
    windows = [(i, w) for i, w in windows if w.strip()]
    first = np.array([i for i, _ in windows], dtype=np.int64)
    return first, np.full(len(first), size), np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for _, w in windows), dtype="<i8").reshape(-1, 2)


_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")  # ends after . ! ? or at a line's end
_WORD = re.compile(r"\S+\s*")
_hash = xxhash.xxh3_128_digest


def _cuts(words: list[str]) -> list[int]:
    """How many words of a long sentence stand before each of its cuts, which follow words chosen by their own hash."""
    return [i for i, w in enumerate(words[:-1], 1) if zlib.crc32(w.encode()) % 6 == 0]


def sentence_units(text: str, longest: int = 12) -> Units:
    """Sentences; one of more than ``longest`` words is cut after words chosen by their own hash.

    The cuts depend on the words alone, so equal passages are cut alike
    wherever they stand.
    """
    out: Units = []
    at = 0
    for sentence in _SENTENCE.findall(text):  # the matches leave no gaps
        end = at + len(sentence)
        if len(sentence) > 2 * longest and len(words := sentence.split()) > longest and (cuts := _cuts(words)):
            lead = len(sentence) - len(sentence.lstrip())
            ends = list(accumulate(map(len, _WORD.findall(sentence)), initial=at + lead))
            for n in cuts:
                out.append((at, ends[n]))
                at = ends[n]
        out.append((at, end))
        at = end
    return out


def sentence_words(text: str, longest: int = 12) -> Hashed:
    """The hash and the number of the words of each of ``sentence_units``; a sentence is split once."""
    hashes, counts = [], []
    for sentence in _SENTENCE.findall(text):
        words = sentence.split()
        if len(words) > longest:
            at = 0
            for n in _cuts(words):
                hashes.append(_hash(" ".join(words[at:n])))
                counts.append(n - at)
                at = n
            words = words[at:] if at else words
        hashes.append(_hash(" ".join(words)))
        counts.append(len(words))
    return b"".join(hashes), counts


def sentence_count(text: str, longest: int = 12) -> int:
    """How many ``sentence_units`` a text has."""
    words = map(str.split, _SENTENCE.findall(text))
    return sum([1 + len(_cuts(w)) if len(w) > longest else 1 for w in words])


def _powers(n: int, known: list[np.ndarray] = []) -> list[np.ndarray]:
    """Powers 0 to ``n`` at least of ``_BASE`` and its inverse, kept for the next call."""
    if not known or len(known[0]) <= n:
        size = max(n, 1 << 18)
        known[:] = [np.cumprod(np.vstack([np.ones((1, 2), dtype="<u8"), np.broadcast_to(p, (size, 2))]), axis=0, dtype="<u8") for p in (_BASE, _INVERSE)]
    return known


def runs_of_words(texts: list[Hashed], size: int, min_words: int) -> RunsOf:
    """``sentence_runs`` of several texts at once."""
    units = np.array([len(counts) for _, counts in texts], dtype=np.int64)
    ends = np.cumsum(units)
    sentences = np.frombuffer(b"".join([h for h, _ in texts]), dtype="<u8").reshape(-1, 2)
    before = np.concatenate([[0], np.cumsum(np.fromiter(chain.from_iterable(counts for _, counts in texts), np.int64, len(sentences)))])
    first = np.arange(len(sentences))
    end = np.maximum(first + size, np.searchsorted(before, before[:-1] + min_words))
    of = np.repeat(np.arange(len(texts)), units)
    inside = np.flatnonzero(end <= ends[of])
    first, end, of = first[inside], end[inside], of[inside]
    # a run's hash is the polynomial of its sentences' hashes, from sums up to each sentence (modulo 2 ** 64)
    powers, inverse = _powers(len(sentences))
    sums = np.vstack([np.zeros((1, 2), dtype="<u8"), np.cumsum(sentences * powers[: len(sentences)], axis=0, dtype="<u8")])
    return of, first - (ends - units)[of], end - first, ((sums[end] - sums[first]) * inverse[first]).astype("<i8")


def sentence_runs(text: str, units: Units, size: int, min_words: int) -> Runs:
    """From each sentence on, the shortest run of at least ``size`` sentences and ``min_words`` words (blanks between words don't count)."""
    own = [text[a:b].split() for a, b in units]
    return runs_of_words([(b"".join([_hash(" ".join(w)) for w in own]), [len(w) for w in own])], size, min_words)[1:]


def _runs_by_line(texts: list[str], size: int) -> RunsOf:
    found = [line_runs(t, [], size) for t in texts]
    return np.repeat(np.arange(len(texts)), [len(first) for first, _, _ in found]), *(np.concatenate(x) for x in zip(*found))


def _bitmap(repeated: DataFrame) -> np.ndarray:
    """Bitmap of the hashes in ``repeated``; its size is fixed, whatever the input."""
    bit = F.pmod("h", F.lit(64 * FILTER_WORDS))
    set_bits = repeated.groupBy(F.shiftrightunsigned(bit, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(h, 64) as int))")).alias("bits"))
    got = set_bits.toArrow()
    out = np.zeros(FILTER_WORDS, dtype=np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out


def remove_repeats(docs: DataFrame, units: Callable[[str], Units], count_units: Callable[[str], int], split: Callable[[str], Any], runs: Callable[[list], RunsOf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows: ``row`` (struct of the columns but the text), ``text`` (what is kept), ``n_units``, ``n_removed``.

    ``split`` gives what ``runs`` reads of a text, for several texts at once;
    ``count_units`` is the number of ``units``, for texts that lose none.
    """
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("d"))
    texts = docs.select(key.alias("key"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())

    def runs_of(batch: pa.RecordBatch, part: int = 1 << 20) -> Iterator[list[np.ndarray]]:
        """Hashes, row, position and length of the runs of a batch, in parts of some ``part`` characters."""
        texts, row, size = [], 0, 0
        column = batch.column(batch.schema.get_field_index("text"))
        for i, t in enumerate(column, 1):
            text = t.as_py()
            texts.append(split(text))
            size += len(text)
            if size > part or i == len(column):
                of, first, n, h = runs(texts)
                if len(first):
                    yield [h, of + row, first, n]
                texts, row, size = [], i, 0

    def count(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            for h, *_ in runs_of(batch):
                values, n = np.unique(h[:, 0], return_counts=True)
                yield pa.record_batch({"h": pa.array(values), "n": pa.array(n.astype(np.int32))})

    counted = texts.select("text").mapInArrow(count, "h long, n int").groupBy("h").agg(F.sum("n").alias("n"))
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(counted.where("n > 1").select("h")))

    def emit(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            for h, *rest in runs_of(batch):
                at = np.mod(h[:, 0], 64 * FILTER_WORDS)
                hit = np.flatnonzero((bits.value[at >> 6] >> (at & 63)) & 1)
                of, pos, n = (x.astype(np.int32)[hit] for x in rest)
                if len(hit):
                    yield pa.record_batch({"ha": pa.array(h[hit, 0]), "hb": pa.array(h[hit, 1]), "key": batch.column(0).take(pa.array(of)), "pos": pa.array(pos), "n": pa.array(n)})

    found = written(texts.mapInArrow(emit, f"ha long, hb long, key {texts.schema['key'].dataType.simpleString()}, pos int, n int"), "repeated-runs")
    at = F.struct("key", "pos")
    firsts = found.groupBy("ha", "hb").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first != last").select("ha", "hb", "first")
    # sort-merge joins at every size: they can split a hot key and need no side in memory
    later = found.join(written(firsts, "first-runs").hint("merge"), ["ha", "hb"]).where(at != F.col("first"))
    covered = later.groupBy("key").agg(F.collect_set(F.struct("pos", "n")).alias("covered")).select(F.col("key").alias("k"), "covered")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    whole = docs.select(F.struct(*rest).alias("row"), F.col(text_col).alias("text"), key.alias("key"))
    joined = whole.join(written(covered, "covered").hint("merge"), F.col("key").eqNullSafe(F.col("k")), "left").select("row", "text", "covered")

    def rebuild(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            kept, counts, removed = [], [], []
            found = batch.column(2).flatten()
            first = found.field("pos").to_numpy()
            end = first + found.field("n").to_numpy()
            at = np.cumsum(pa.compute.list_value_length(batch.column(2)).fill_null(0)).tolist()
            for t, a, b in zip(batch.column(1), [0, *at], at):
                text = t.as_py()
                if a == b:
                    counts.append(count_units(text) if text else 0)
                    removed.append(0)
                    kept.append(text)
                    continue
                own = units(text)
                edges = np.bincount(first[a:b], minlength=len(own) + 1) - np.bincount(end[a:b], minlength=len(own) + 1)
                gone = (np.cumsum(edges)[:-1] > 0).tolist()
                text = "".join([text[x:y] for (x, y), g in zip(own, gone) if not g])
                kept.append(text.removesuffix("\n") if gone[-1] else text)
                counts.append(len(own))
                removed.append(sum(gone))
            yield pa.record_batch({"row": batch.column(0), "text": pa.array(kept, pa.string()), "n_units": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64())})

    return joined.mapInArrow(rebuild, f"row {whole.schema['row'].dataType.simpleString()}, text string, n_units long, n_removed long")


def dedup_lines(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Operator 5: overlapping windows of ``window`` lines; see ``remove_repeats`` for the columns.

    A document of fewer lines has no window and is left alone.
    """
    return remove_repeats(docs, line_units, lambda t: t.count("\n") + 1, str, lambda texts: _runs_by_line(texts, window), id_col, text_col)


def dedup_sentences(docs: DataFrame, span: int = 3, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Operator 2: sliding runs of ``span`` sentences (more where they have fewer than ``min_words`` words)."""
    return remove_repeats(docs, sentence_units, sentence_count, sentence_words, lambda texts: runs_of_words(texts, span, min_words), id_col, text_col)
