"""Word positions and 64-bit word hashes of many texts at once, in numpy.

A word is a maximal run of bytes of one class; words never cross texts.  The
hash of a word is a polynomial over random 64-bit values of its (folded)
bytes, mixed with its length, so equal words hash alike wherever they stand.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240917))
_VALUE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 19


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64; one table per base, grown as needed."""
    table = _TABLES.get(base)
    if table is None or len(table) < n:
        table = np.empty(1 << max(n - 1, 1).bit_length(), np.uint64)
        table[0] = 1
        done, step = 1, base
        while done < len(table):  # doubling: table[n:2n] = table[:n] * base**n
            table[done:2 * done] = table[:done] * np.uint64(step)
            done, step = 2 * done, step * step % 2**64
        _TABLES[base] = table
    return table[:n]


def powers(n: int) -> np.ndarray:
    return _powers(int(_BASE), n)


def inverse_powers(n: int) -> np.ndarray:
    return _powers(pow(int(_BASE), -1, 2**64), n)


_POW, _INV = powers(_PIECE), inverse_powers(_PIECE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordClass:
    """Which bytes make words, and how a byte is folded before hashing."""

    def __init__(self, is_word: np.ndarray, fold_ascii: bool = True):
        self.is_word = is_word
        fold = np.arange(256)
        if fold_ascii:
            fold[65:91] += 32
        self.value = _VALUE[fold]


def _table(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], bool)


# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after folding A-Z: digits, letters, all non-ASCII.
ALNUM = WordClass(_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128))
# [^\x20\x09-\x0D]+ after folding A-Z: whatever white space separates.
SPACED = WordClass(_table(lambda b: not (b == 32 or 9 <= b <= 13)))


def find_words(buf: np.ndarray, offsets: np.ndarray, kind: WordClass):
    """Start, end and hash of every word, in order, and per text the index of
    its first word (n+1 entries)."""
    on = kind.is_word[buf]
    n = len(buf)
    if not on.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = on[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = False
    starts = np.flatnonzero(on & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = on[1:]
    cuts = offsets[1:][offsets[1:] > 0] - 1
    after[cuts] = False
    ends = np.flatnonzero(on & ~after) + 1
    hashes = hash_ranges(buf, starts, ends, kind.value)
    return starts, ends, hashes, np.searchsorted(starts, offsets).astype(np.int64)


def hash_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                value: np.ndarray = _VALUE) -> np.ndarray:
    """64-bit hash of each byte range; the ranges ascend and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    i, m = 0, len(starts)
    while i < m:
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + _PIECE, side="right"))
        if j <= i:  # one range longer than a piece: fold its pieces in order
            acc = np.uint64(0)
            for a in range(base, int(ends[i]), _PIECE):
                b = min(a + _PIECE, int(ends[i]))
                part = np.sum(value[buf[a:b]] * _POW[:b - a], dtype=np.uint64)
                acc = mix(np.array([acc ^ part], np.uint64))[0]
            out[i] = acc
            j = i + 1
        else:
            stop = int(ends[j - 1])
            prefix = np.empty(stop - base + 1, np.uint64)
            prefix[0] = 0
            np.cumsum(value[buf[base:stop]] * _POW[:stop - base], out=prefix[1:])
            s = starts[i:j] - base
            out[i:j] = (prefix[ends[i:j] - base] - prefix[s]) * _INV[s]
        i = j
    return mix(out ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


_STEP = mix(np.arange(1, 65, dtype=np.uint64))  # one odd multiplier per place in a run
_STEP |= np.uint64(1)


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive word hashes (len - size + 1)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(size):
        acc += hashes[k:k + n] * _STEP[k]
    return mix(acc)


def sequence_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for a whole short sequence of word hashes."""
    return mix(np.array([np.sum(hashes * _STEP[:len(hashes)], dtype=np.uint64)
                         + np.uint64(len(hashes))], np.uint64))
