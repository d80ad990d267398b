"""Sliding sentence spans against a plain loop."""

import re

import numpy as np
import pyarrow as pa

from helpers import FOLD, frame, rng, sentence
from measures.llm import sentence_spans as S
from measures.llm import words as W
from measures.llm.common import text_buffer


def units(text):
    """(start, end, word) of each word; those of long words, character by character."""
    for w in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if len(w.group().encode()) > S.LONG_WORD:
            yield from ((w.start() + k, w.start() + k + 1, c) for k, c in enumerate(w.group()))
        else:
            yield w.start(), w.end(), w.group()


def rank(word):
    buf, offsets = text_buffer(pa.array([word.translate(FOLD)]))
    h = W.hash_ranges(buf, offsets[:-1], offsets[1:], W.SPACED.value)
    return int(W.mix(h ^ S._CHOICE)[0])


def sentences_of(text):
    whole, cur, words = [], [], list(units(text or ""))
    for k, w in enumerate(words):
        cur.append(w)
        gap = text[w[1]:words[k + 1][0]] if k + 1 < len(words) else "\n"
        if w[2][-1] in ".!?" or "\n" in gap:
            whole.append(cur)
            cur = []
    out = []
    for s in whole:
        ranks = [rank(w[2]) for w in s]
        cuts = {min(range(i, i + S.LONG), key=lambda j: (ranks[j], j))
                for i in range(len(s) - S.LONG + 1)}
        cur = []
        for j, w in enumerate(s):
            cur.append(w)
            if j in cuts or j == len(s) - 1:
                out.append(cur)
                cur = []
    return out


def brute(docs):
    runs, out = {}, {}
    cut = {i: sentences_of(docs[i]) for i in sorted(docs)}
    gone = {i: set() for i in docs}
    for i, s in cut.items():
        for a in range(len(s) - S.SENTENCES + 1):
            key = tuple(w[2].translate(FOLD) for x in s[a:a + S.SENTENCES] for w in x)
            if key in runs:
                gone[i].update(range(a, a + S.SENTENCES))
            runs[key] = True
    for i, s in cut.items():
        text = docs[i] or ""
        edge = [0] + [x[0][0] for x in s[1:]] + [len(text)]
        kept = text if not s else "".join(text[edge[j]:edge[j + 1]] for j in range(len(s))
                                          if j not in gone[i])
        out[i] = (len(s), len(gone[i]), kept)
    return out


def found(spark, texts):
    got = S.remove_repeated_spans(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    return {x.id: (x.n_sentences, x.n_removed, x.kept) for x in got}


def test_against_a_loop(spark):
    r = rng(3)
    lines = [sentence(r, r.randint(1, 14)) + r.choice([".", "!", "?", ""]) for _ in range(40)]
    texts = [None, "", " \n ", ". . .", sentence(r, 30), "x" * 9_000, "  " + sentence(r, 40)]
    for _ in range(25):
        a, n = r.randrange(35), r.randint(1, 12)
        texts.append("".join(x + r.choice([" ", "\n", "  "]) for x in lines[a:a + n]))
    texts += [texts[8], texts[8].upper(), texts[9] + texts[9], "é " + texts[10] + " ü"]
    assert found(spark, texts) == brute(dict(enumerate(texts)))


def test_very_long_and_very_common_texts(spark):
    r = rng(4)
    long = " ".join(sentence(r, r.randint(1, 30)) + "." for _ in range(2500))
    texts = [long, long] + [sentence(r, 60) + " " + long[:300] for _ in range(150)]
    assert found(spark, texts) == brute(dict(enumerate(texts)))


def test_repeated_and_null_ids_and_empty(spark):
    text = (sentence(rng(1), 7) + ". ") * 5
    df = frame(spark, [text, text, "other one."], [None, 4, None])
    got = {(x.id, x.n_sentences): x.n_removed for x in S.remove_repeated_spans(df).collect()}
    assert got[None, 5] == 4 and got[4, 5] == 5 and got[None, 1] == 0
    assert S.remove_repeated_spans(df.limit(0)).count() == 0


def test_clashing_columns(spark):
    text = (sentence(rng(1), 7) + ". ") * 5
    df = spark.createDataFrame([(i, text, "s", 1, 2, 3) for i in range(2)],
                               "doc_id long, text string, id string, th int, place int, h1 int")
    assert sorted(r.n_removed for r in S.remove_repeated_spans(df).collect()) == [4, 5]


def test_pieces_are_short():
    r = np.random.Generator(np.random.PCG64(1))
    words = " ".join(f"w{r.integers(0, 5000)}" for _ in range(3000))
    s = S.Sentences(*text_buffer(pa.array([words])))
    assert np.diff(np.concatenate([[0], s.end])).max() <= S.LONG
