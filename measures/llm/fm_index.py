"""An FM-index over a sequence of small integers, searched in bulk with numpy.

Symbol 0 separates the runs of the text and is never searched.  Rows of the
Burrows-Wheeler transform are counted by a wavelet matrix (one bit plane per
bit of a symbol, with running counts of ones); all patterns take their
backward steps together.  Positions are found by walking back to a sampled
suffix position.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; every separator 0 is a symbol of its own, so
    that comparisons end at the end of a run."""
    n = len(text)
    rank = text.astype(np.int64)
    gaps = np.flatnonzero(text == 0)
    rank += len(gaps)
    rank[gaps] = np.arange(len(gaps))
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        head = rank[order]
        later = np.full(n, -1, np.int64)
        later[:max(n - step, 0)] = rank[step:]
        if step == 1:
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(head[1:] != head[:-1])])
            rank = new
            later[:max(n - 1, 0)] = rank[1:]
        key = rank * (n + 1) + later + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new
        step *= 2
        if rank[order[-1]] == n - 1 or step > 2 * n:
            return order


class WaveletMatrix:
    """rank(c, i): occurrences of c among the first i symbols, in bulk."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        seq = symbols
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros_like(i)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            up = ((c >> b) & 1).astype(bool)
            i = np.where(up, zeros + ones[i], i - ones[i])
            start = np.where(up, zeros + ones[start], start - ones[start])
        return i - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at i and its rank there."""
        c, start = np.zeros_like(i), np.zeros_like(i)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            up = (ones[i + 1] - ones[i]).astype(bool)
            c = 2 * c + up
            i = np.where(up, zeros + ones[i], i - ones[i])
            start = np.where(up, zeros + ones[start], start - ones[start])
        return c, i - start


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE_EVERY):
        """text: runs of symbols 1..sigma-1, each run followed by a 0."""
        order = suffix_order(text)
        self.n = len(text)
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        # Walks never step over a separator: run starts are sampled too.
        kept = (order % sample == 0) | (text[order - 1] == 0)
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the patterns (rows right-aligned, 0-padded)."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for k in range(width):
            live = live[(lengths[live] > k) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = patterns[live, width - 1 - k]
            lo[live] = self.first[c] + self.bwt.rank(c, lo[live])
            hi[live] = self.first[c] + self.bwt.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.kept[rows])
        while len(walking):
            c, before = self.bwt.access(rows[walking])
            rows[walking] = self.first[c] + before
            steps[walking] += 1
            walking = walking[~self.kept[rows[walking]]]
        return self.positions[self.kept_before[rows]] + steps
