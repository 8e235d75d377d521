"""An FM-index over a shard of documents, with numpy.

The shard is one sequence of word numbers; a separator of its own follows
each document. The index keeps the Burrows-Wheeler transform as a wavelet
matrix (one packed bit array with rank counts for each bit of a word number),
the counts C of smaller symbols, and every ``SAMPLE``-th suffix position.
Patterns are counted by backward search, all at once, and located by walking
the last-to-first mapping to a sampled position.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; each round sorts only suffixes still tied.

    The last symbol must occur once.
    """
    n = len(symbols)
    follow = np.append(symbols[1:], 0)
    key = symbols * (int(symbols.max()) + 1) + follow if n else symbols
    sa = np.argsort(key, kind="stable")
    slots, idx, key, h = np.arange(n), sa, key[sa], 2
    rank = np.empty(n, dtype=np.int64)
    while len(idx):
        new = np.append(True, key[1:] != key[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(idx)), 0))
        rank[idx] = slots[start]
        sa[slots] = idx
        tied = ~(new & np.append(new[1:], True))
        slots, idx = slots[tied], idx[tied]
        key = rank[idx] * n + rank[np.minimum(idx + h, n - 1)]
        order = np.argsort(key, kind="stable")
        idx, key, h = idx[order], key[order], 2 * h
    return sa


class Bits:
    """Bit array with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n >> 6) + 1, dtype=np.uint64)
        raw = np.packbits(bits, bitorder="little")
        packed.view(np.uint8)[: len(raw)] = raw
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w, mask = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class FmIndex:
    """Index of documents given as arrays of word numbers from 1 on (0 is the separator)."""

    def __init__(self, symbols: np.ndarray, separators: np.ndarray):
        """``symbols``: all documents, each with a 0 at its end; ``separators``: positions of these."""
        n = self.n = len(symbols)
        top = int(symbols.max()) if n else 0
        unique = symbols + len(separators)  # each separator sorts as a symbol of its own, below all words
        unique[separators] = np.arange(len(separators))
        sa = suffix_array(unique)
        bwt = symbols[sa - 1]
        # LF is not defined at a separator, so document starts are sampled too
        sampled = (sa % SAMPLE == 0) | (bwt == 0)
        self.marked = Bits(sampled)
        self.positions = sa[sampled].astype(np.int32 if n < 2**31 else np.int64)
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.levels, self.zeros = [], []
        self.depth = max(1, top.bit_length())
        for level in range(self.depth - 1, -1, -1):
            bits = (bwt >> level) & 1
            ones = bits.astype(bool)
            self.levels.append(Bits(ones))
            self.zeros.append(n - int(ones.sum()))
            bwt = np.concatenate([bwt[~ones], bwt[ones]])

    def _down(self, symbol: np.ndarray, *at: np.ndarray) -> list[np.ndarray]:
        """Positions ``at`` of the transform, followed down the levels by the bits of ``symbol``."""
        found = list(at)
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.depth - 1 - k)) & 1 == 1
            for j, i in enumerate(found):
                r = bits.rank(i)
                found[j] = np.where(one, zeros + r, i - r)
        return found

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [start, end) of patterns; ``patterns`` are right-aligned rows of word numbers."""
        start = np.zeros(len(patterns), dtype=np.int64)
        end = np.full(len(patterns), self.n, dtype=np.int64)
        width = patterns.shape[1]
        for k in range(width - 1, -1, -1):
            live = np.flatnonzero((lengths >= width - k) & (end > start))
            if not len(live):
                break
            c = patterns[live, k]
            zero, a, b = self._down(c, np.zeros(len(live), dtype=np.int64), start[live], end[live])
            start[live], end[live] = self.counts[c] + a - zero, self.counts[c] + b - zero
        return start, end

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the sorted suffixes."""
        out = np.empty(len(rows), dtype=np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.marked.get(at) == 1
            out[todo[hit]] = self.positions[self.marked.rank(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            symbol, i, zero = np.zeros(len(at), dtype=np.int64), at, np.zeros(len(at), dtype=np.int64)
            for bits, zeros in zip(self.levels, self.zeros):
                one = bits.get(i).astype(bool)
                r, z = bits.rank(i), bits.rank(zero)
                symbol = (symbol << 1) | one
                i, zero = np.where(one, zeros + r, i - r), np.where(one, zeros + z, zero - z)
            at = self.counts[symbol] + i - zero
            steps += 1
        return out
