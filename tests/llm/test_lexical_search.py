"""The search by range maxima against every score worked out."""

import math
from collections import Counter

import numpy as np
import pytest

from helpers import alnum_words, frame, rng
from measures.llm import lexical_search as L


def brute(texts, items, k, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = [Counter(alnum_words(t)) for t in texts]
    n_docs, n_terms = sum(map(bool, docs)), sum(sum(d.values()) for d in docs)
    df = Counter(t for d in docs for t in d)
    out = []
    for item, text in items:
        found = []
        for i, d in zip(ids, docs):
            score, n = 0, sum(d.values())
            for t, q in Counter(alnum_words(text)).items():
                if d[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + 25 * n * n_docs // n_terms
                    score += q * w * (1_000_000_000 * d[t] // (1000 * d[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=lambda r: r[:2])


def search(spark, texts, items, k, ids=None):
    index = L.build_index(frame(spark, texts, ids))
    queries = spark.createDataFrame(items, "item_id bigint, text string")
    found = L.search(index, queries, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])


def corpus(seed, n):
    r = rng(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "Été", "The"]
    text = lambda m: r.choice([" ", ", ", "\n"]).join(
        words[int(len(words) * r.random() ** 2)] for _ in range(m))
    return [text(r.randint(1, 40)) for _ in range(n)], [(i, text(r.randint(1, 12)))
                                                        for i in range(12)]


@pytest.mark.parametrize("k", [1, 5, 20])
def test_random_texts(spark, monkeypatch, k):
    monkeypatch.setattr(L, "AT_ONCE", 3)
    texts, items = corpus(k, 200)
    assert search(spark, texts, items, k) == brute(texts, items, k)


def test_shards_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 40)
    texts, items = corpus(9, 60)
    texts = texts + texts[:10] * 12  # copies tie: the least ids stay
    assert search(spark, texts, items, 7) == brute(texts, items, 7)


def test_shards_of_a_few_documents():
    """Shards cut anywhere hold all postings, and share their best scores."""
    import pyarrow as pa
    texts, items = corpus(11, 150)
    ids = [(i * 37) % 150 for i in range(150)]
    shards, now = [], L._Shard()
    for i in range(0, 150, 10):
        now.add(pa.array(ids[i:i + 10], pa.int64()), pa.array(texts[i:i + 10]))
        if i % 30 == 20:
            shards.append(now.row())
            now = L._Shard()
    block = L._block([i for i, _ in items], [t for _, t in items])
    block.n_docs, block.n_terms = sum(s[0] for s in shards), sum(s[1] for s in shards)
    names = [c.split()[0] for c in L.SHARD.split(", ")]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*shards), [pa.int64()] * 3 + [pa.binary()] * 6)],
        names=names)
    df = next(L._count(iter([batch]), block)).to_pydict()
    counts = dict(zip(df["term"], df["df"]))
    block.weights = np.array([L.weight(block.n_docs, counts.get(t, 0))
                              for t in range(len(block.vocab))], np.int64)
    found = [tuple(r.values()) for b in L._best(iter([batch]), block, 6) for r in b.to_pylist()]
    want = [(q, d, s) for q, _, d, s in brute(texts, items, 6, ids)]
    assert sorted(found) == sorted(want)


def test_range_maxima_are_the_first_greatest():
    r = np.random.Generator(np.random.PCG64(3))
    p = L.Postings.__new__(L.Postings)
    p.impacts = r.integers(0, 9, 137)
    p._tabulate(137)
    for lo in range(137):
        for hi in range(lo, 138):
            at = p.greatest(np.array([lo]), np.array([hi]))[0]
            assert at == (lo + p.impacts[lo:hi].argmax() if hi > lo else -1)


def test_nulls_empty_and_long_texts_repeated_rows(spark):
    r = rng(2)
    texts = [None, "", "...", "one two", "one two", "one", " ".join(
        r.choice(["one", "two", "x"]) for _ in range(70_000)), "two " * 300 + "TWO", "é one"]
    ids = [0, 1, 2, 3, 3, None, 6, 7, None]
    items = [(0, "one one two"), (1, None), (2, ""), (3, "absent"), (4, "É é"), (4, "x"), (4, "x")]
    queries = [(0, "one one two"), (4, "x\nÉ é")]
    assert search(spark, texts, [*items, (None, "one")], 4, ids) == brute(texts, queries, 4, ids)


def test_empty_tables_and_clashing_columns(spark):
    assert search(spark, [], [(1, "a")], 3) == []
    assert search(spark, ["a"], [], 3) == []
    docs = spark.createDataFrame([(1, "a b", "s", 3, 4)],
                                 "doc_id long, text string, id string, rank int, score int")
    items = spark.createDataFrame([("q", "a", 1, 2)],
                                  "item_id string, text string, doc_id int, id int")
    assert [r.doc_id for r in L.search(L.build_index(docs), items, 3).collect()] == [1]
