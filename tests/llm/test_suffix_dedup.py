"""Grouping suffix sort, and removal of repeated substrings."""

import collections
import random

import numpy as np
import pytest

from helpers import frame, rng, sentence
from measures.llm import suffix_dedup
from measures.llm.grouping_sort import suffix_order


def test_suffix_order():
    r = random.Random(1)
    for k in range(1500):
        t = [r.randint(1, r.randint(1, 4)) for _ in range(r.randint(0, 40))]
        if k % 3 == 0:
            t = (t[:5] * 9)[:40]
        t.append(0)
        assert suffix_order(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def brute(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(int)) == 1) + gone[0])
        out.append((len(d), int(gone.sum()), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def corpus():
    r = rng(5)
    base = sentence(r, 120)
    near = base[:300] + "#" + base[301:]
    return [None, "", base, base, near, base[50:249], base[50:250] + "é" * 150, sentence(r, 500),
            "ab" * 400, "x" * 199, "y" * 200, "z" * 201, "é" * 99 + base[:203], base[3:203] + base[3:203],
            sentence(r, 40) + base[100:330] + sentence(r, 40), "Of " * 200 + base[:60]]


@pytest.mark.parametrize("crowded", [5000, 0])
def test_against_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "KEY_FRAGMENTS", crowded)
    texts = corpus()
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_long_text_in_pieces():
    import pyarrow as pa
    text = sentence(rng(8), 2000)
    windows = 0
    old, suffix_dedup.PIECE = suffix_dedup.PIECE, 1000
    try:
        for buf, offsets, _, base in suffix_dedup.pieces(pa.array([text]), 200):
            _, _, _, first, last = suffix_dedup.fragments(buf, offsets, 200, 32)
            windows += int((last - first + 1).sum())
    finally:
        suffix_dedup.PIECE = old
    assert windows == len(text) - 199


def test_repeated_rows_null_ids_and_empty(spark):
    text = sentence(rng(6), 60)
    df = frame(spark, [text, text, text, "short"], [None, 1, 1, None])
    got = sorted((str(r.id), r.n_removed) for r in suffix_dedup.remove_repeats(df).collect())
    n = len(text)
    assert got == [("1", n), ("1", n), ("None", 0), ("None", n)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
