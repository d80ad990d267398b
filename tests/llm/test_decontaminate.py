"""FM-index search against plain search, and the contract's rule."""

import numpy as np
import pytest

from helpers import alnum_words, frame, rng, sentence
from measures.llm.decontaminate import contaminated, find_contamination
from measures.llm.fm_index import FMIndex


def test_index_finds_every_occurrence():
    r = np.random.Generator(np.random.PCG64(5))
    for sigma in (2, 3, 9):
        text = r.integers(0, sigma, 400)
        text[-1] = 0
        index = FMIndex(text, sigma)
        patterns = np.zeros((60, 4), np.int64)
        lengths = r.integers(1, 5, 60)
        for i, n in enumerate(lengths):
            patterns[i, 4 - n:] = r.integers(1, sigma, n)
        lo, hi = index.search(patterns, lengths)
        for i, n in enumerate(lengths):
            want = [p for p in range(len(text) - n + 1)
                    if (text[p:p + n] == patterns[i, 4 - n:]).all()]
            assert sorted(index.locate(np.arange(lo[i], hi[i])).tolist()) == want


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = alnum_words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, ids = alnum_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    ids |= found
        out.append((len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_against_brute_force(spark, block_bytes):
    r = rng()
    items = [(i, sentence(r, n)) for i, n in enumerate((20, 13, 14, 5, 1, 0, 40))]
    items += [(7, None), (None, sentence(r, 15)), (0, sentence(r, 16)), (8, items[0][1])]
    part = items[0][1].split()
    texts = [None, "", "  ", items[2][1].upper(), sentence(r, 30) + ". " + items[0][1] + "! x",
             " ".join(part[3:16]), " ".join(part[3:15]), items[3][1] + " " + items[3][1],
             sentence(r, 3000) + " " + items[1][1], "Ünï " + items[4][1] + "\tÄ", "x" * 50_000]
    texts += [texts[4], items[6][1] * 3]
    bench = frame(spark, [t for _, t in items], [i for i, _ in items], "item_id bigint, text string")
    got = contaminated(find_contamination(frame(spark, texts), bench, block_bytes=block_bytes))
    rows = {x.doc_id: x for x in got.collect()}
    assert [(rows[i].n_words, rows[i].n_hit, list(rows[i].items), rows[i].contaminated)
            for i in range(len(texts))] == brute(texts, items)
    for i, text in enumerate(texts):  # spans cut out what was hit
        raw = (text or "").encode()
        assert sum(len(alnum_words(raw[s.start:s.end].decode())) for s in rows[i].spans) == \
            rows[i].n_hit


def test_empty_tables(spark):
    docs, bench = frame(spark, ["a b"]), frame(spark, ["a b"], schema="item_id bigint, text string")
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert find_contamination(docs, bench.limit(0)).first().n_hit == 0
