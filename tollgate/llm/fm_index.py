"""FM-index over a sequence of integer symbols, worked in vectors.

Suffix array by prefix doubling, Burrows-Wheeler transform in a wavelet tree
(matrix layout) whose bit vectors carry a rank directory of one count per
64-bit word, and every ``SAMPLE``-th suffix position kept for locating.  All
queries take arrays, so that a whole set of patterns steps together.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


class RankBits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.directory = np.concatenate(([0], np.cumsum(counts)[:-1]))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.directory[word] + np.bitwise_count(self.words[word] & low).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Rank and access over symbols below ``2**levels``."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.zeros = [], []
        for shift in range(self.levels - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.bits.append(RankBits(bit.astype(np.uint8)))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol before position i."""
        begin = np.zeros(len(i), np.int64)
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            b, e = bits.rank(begin), bits.rank(i)
            begin, i = np.where(one, zeros + b, begin - b), np.where(one, zeros + e, i - e)
        return i - begin

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.bits, self.zeros):
            one, r = bits.get(i), bits.rank(i)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + r, i - r)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling: ranks of 1, 2, 4, ... symbols until all differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = fresh
        if rank[order[-1]] == n - 1 or k >= n:
            return order
        k *= 2


class FMIndex:
    """Symbols are at least 1; 0 is the end of the text."""

    def __init__(self, text: np.ndarray, sigma: int):
        text = np.concatenate((text.astype(np.int64), [0]))
        order = suffix_array(text)
        self.n = len(text)
        last = text[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=sigma))))
        self.tree = WaveletTree(last, sigma)
        marked = order % SAMPLE == 0
        self.marked, self.samples = RankBits(marked.astype(np.uint8)), order[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long patterns (one per row): the range
        [lo, hi) of suffixes that begin with each."""
        count, length = patterns.shape
        lo, hi = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        live = np.arange(count)
        for j in range(length - 1, -1, -1):
            c = patterns[live, j]
            both = self.tree.rank(np.concatenate((c, c)), np.concatenate((lo[live], hi[live])))
            lo[live], hi[live] = self.before[c] + both[: len(c)], self.before[c] + both[len(c):]
            live = live[hi[live] > lo[live]]
            if not len(live):
                break
        gone = np.ones(count, bool)
        gone[live] = False
        lo[gone] = hi[gone] = 0
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step back to the next sampled one."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            i = at[live]
            hit = self.marked.get(i)
            done = live[hit]
            out[done] = self.samples[self.marked.rank(i[hit])] + steps[done]
            live, i = live[~hit], i[~hit]
            c = self.tree.access(i)
            at[live] = self.before[c] + self.tree.rank(c, i)
            steps[live] += 1
        return out
