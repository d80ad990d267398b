"""Token-group Jaccard components against all pairs."""

import pytest

from helpers import frame, rng, sentence, spaced_words
from measures.llm import jaccard


def shingles(text):
    w = spaced_words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(ids, texts):
    sets, up = [shingles(t) for t in texts], {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and ids[i] is not None and ids[j] is not None and \
                    100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(ids[i]), find(ids[j])))
                up[b] = a
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in zip(ids, sets)), key=str)


def corpus(r):
    texts = [None, "", " \n", "one two", "One  TWO", "one two three four five",
             "one two three four five six", "same " * 40, "same " * 9, sentence(r, 4000)]
    for _ in range(6):  # chains of near copies, some borderline
        base = sentence(r, 60).split()
        for _ in range(12):
            texts.append(" ".join(base))
            at = r.randrange(55)
            base[at:at + r.randint(1, 3)] = sentence(r, r.randint(0, 3)).split()
    shared = sentence(r, 30)
    texts += [sentence(r, r.randint(5, 60)) + " " + shared for _ in range(20)]
    return texts + texts[10:14]


@pytest.mark.parametrize("group, common", [(48, 200), (2, 1), (1, 3)])
def test_against_all_pairs(spark, monkeypatch, group, common):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "COMMON_IN", common)
    texts = corpus(rng(group))
    ids = [(7 * i) % 1009 for i in range(len(texts))]
    got = jaccard.jaccard_components(frame(spark, texts, ids))
    assert sorted(map(tuple, got.collect()), key=str) == brute(ids, texts)


def test_null_and_repeated_ids_and_empty(spark):
    r = rng(2)
    a, b = sentence(r, 50), sentence(r, 50)
    df = frame(spark, [a, a, b, b, a], [None, 3, 3, 9, 5])
    got = sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 46, None), (3, 46, 3), (3, 46, 3), (9, 46, 3), (5, 46, 3)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
