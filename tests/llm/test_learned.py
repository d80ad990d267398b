"""Toxicity neighbours and pairwise quality."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from helpers import alnum_words, frame, rng, sentence
from measures.llm import quality, toxicity
from measures.llm.labelled import is_held_out

LABELS = "doc_id bigint, quality int, toxic int"


def toxic_corpus(spark, n=400):
    r = rng(11)
    texts, labels = [], []
    for i in range(n):
        toxic = int(r.random() < 0.3)
        words = sentence(r, r.randint(20, 60)).split()
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(["vileword", "nastyone", "uglything"]))
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    return frame(spark, texts + [None, "", texts[0]], list(range(n + 3))), \
        spark.createDataFrame(labels + [(n, None, None), (None, 1, 1)], LABELS), labels


def test_fold():
    import pyspark.sql  # noqa: F401
    for i in range(20):
        assert isinstance(zlib.crc32(str(i).encode()) % 5 == 0, bool)


def test_toxicity_is_learned_and_held_out(spark):
    docs, labels, known = toxic_corpus(spark)
    index = toxicity.fit(docs, labels)
    out = toxicity.with_fold(toxicity.score(docs, index), 0.5)
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == 403
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [(rows[i].predicted, t) for i, _, t in known if rows[i].held_out]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert not {e.example for r in rows.values() for e in r.evidence} & {
        i for i, r in rows.items() if r.held_out}
    assert rows[400].score == rows[401].score == index.base_rate
    assert rows[402].score == rows[0].score


def test_nearest_are_exact(spark):
    docs, labels, _ = toxic_corpus(spark)
    index = toxicity.fit(docs, labels)
    dense = np.zeros((len(index.ids), len(index.idf)))
    dense[index.post_rank, index.post_term] = index.post_weight
    r = np.random.Generator(np.random.PCG64(1))
    for _ in range(50):
        terms = np.sort(r.choice(len(index.idf), r.integers(1, min(5, len(index.idf)) + 1),
                                 replace=False))
        q = index.unit(terms, r.integers(1, 4, len(terms)))
        cosines = dense[:, terms] @ q
        want = np.sort(cosines[cosines > 0])[::-1][:7]
        assert np.allclose(index.nearest(terms, q, 7)[1], want)


def vote_again(docs, labels, k=16, least=3):
    """Scores and neighbours from the raw texts, term by term."""
    def counts(text):
        words = alnum_words(text)
        found = Counter(("word", w) for w in words)
        for n in (4, 5, 6):
            found.update((n, w.encode()[:n]) for w in words if len(w.encode()) > n)
        return found

    y = {i: t for i, _, t in labels
         if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5}
    seen, toxic = Counter(), Counter()
    known = {i: counts(docs[i]) for i in y}
    for i, found in known.items():
        for term, n in found.items():
            levels = [(term, x) for x in (1, 2, 3, 4, 6) if n >= x]
            seen.update(levels)
            toxic.update(levels * y[i])
    seen_often = {t: n for t, n in seen.items() if n >= least}
    total, p = len(y), sum(y.values())

    def g2(n, pos):
        cells = [(pos, n * p), (n - pos, n * (total - p)), (p - pos, (total - n) * p),
                 (total - n - p + pos, (total - n) * (total - p))]
        return 2 * sum(c * np.log(c * total / e) for c, e in cells if c)

    bar = 2 * np.log(len(seen_often)) + 2
    lean = {t for t, n in seen_often.items() if g2(n, toxic[t]) >= bar
            and toxic[t] / p > (n - toxic[t]) / (total - p)}
    terms = lean | {t for t in seen if t[0][0] == "word" and t[1] == 1}

    def vector(found):
        v = {(t, x): (1 + np.log(n)) * np.log1p(total / seen[t, x]) * (100 if (t, x) in lean else 1)
             for t, n in found.items() for x in (1, 2, 3, 4, 6) if n >= x and (t, x) in terms}
        norm = np.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    examples = {i: vector(found) for i, found in known.items()}
    out = {}
    for i, text in docs.items():
        v = vector(counts(text))
        near = sorted((-round(sum(w * e.get(t, 0) for t, w in v.items()), 12), j)
                      for j, e in examples.items())
        near = [(-c, j) for c, j in near if c < 0][:k]
        weight = [c * c for c, _ in near]
        out[i] = ((sum(w * y[j] for w, (_, j) in zip(weight, near, strict=True)) + p / total)
                  / (sum(weight) + 1), [j for _, j in near])
    return out


def test_toxicity_from_raw_texts(spark):
    docs, labels, known = toxic_corpus(spark, 150)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = vote_again(texts, known)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        assert abs(r.score - want[r.doc_id][0]) < 1e-9
        assert [e.example for e in r.evidence] == want[r.doc_id][1]


def test_a_copy_of_a_labelled_row_is_its_first_neighbour(spark):
    docs, labels, known = toxic_corpus(spark, 120)
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = min(i for i in range(120) if zlib.crc32(str(i).encode()) % 5)
    texts[119] = texts[118] = texts[first]
    learned = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5]
    table = frame(spark, list(texts.values()), list(texts))
    index = toxicity.fit(table, labels)
    copies = frame(spark, [texts[i] for i in learned], [1000 + i for i in learned])
    for r in toxicity.score(copies, index).collect():
        best = r.evidence[0]
        same = [i for i in learned if texts[i] == texts[r.doc_id - 1000]]
        assert best.example == min(same) and abs(best.cosine - 1) < 1e-9
        assert best.label == known[min(same)][2]
        assert [e.example for e in r.evidence[:len(same)]] == same


def test_examples_are_bounded_in_bytes_and_long_texts_are_scored_whole(spark):
    docs, labels, known = toxic_corpus(spark, 100)
    texts = {r.doc_id: r.text for r in docs.collect()}
    long = min(i for i, _, t in known if zlib.crc32(str(i).encode()) % 5 and not t)
    texts[long] = " ".join(["plain"] * 20_000 + ["vileword"])
    table = frame(spark, list(texts.values()), list(texts))
    index = toxicity.fit(table, labels, sample_bytes=32 * 10_000)
    learned = {i for i in range(100) if zlib.crc32(str(i).encode()) % 5}
    assert set(index.ids.tolist()) == learned - {long}
    few = set(toxicity.fit(table, labels, sample_bytes=32 * 400).ids.tolist())
    assert 0 < len(few) < len(learned) and few < set(index.ids.tolist())
    assert sum(len(texts[i]) for i in few) <= 32 * 400
    row = toxicity.score(table.where(F.col("doc_id") == long), index).first()
    assert row.score > 0.5 and len(row.evidence) == toxicity.NEIGHBOURS


def test_toxicity_among_columns_named_like_its_own(spark):
    docs, labels, _ = toxic_corpus(spark, 60)
    plain = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    odd = docs.select("*", *[F.lit("x").alias(c) for c in ("y", "id", "term", "score", "evidence",
                                                           "size", "so_far", "pos")])
    marked = labels.select("*", *[F.lit("x").alias(c) for c in ("y", "text", "id", "size")])
    got = toxicity.score(odd, toxicity.fit(odd, marked)).collect()
    assert {r.doc_id: r.score for r in got} == plain


def test_toxicity_without_labels(spark):
    docs, labels, _ = toxic_corpus(spark, 10)
    index = toxicity.fit(docs, labels.limit(0))
    assert index is None and {r.score for r in toxicity.score(docs, index).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), index).count() == 0


def test_quality_ranks_and_cuts_at_the_quantile(spark):
    r = rng(4)
    texts, labels = [], []
    for i in range(300):
        good = int(r.random() < 0.8)
        texts.append(sentence(r, 40) if good else " ".join([r.choice(["aa", "bb###"])] * 40))
        labels.append((i, good, 0))
    docs = frame(spark, texts + [None, "", "x"], list(range(303)))
    table = spark.createDataFrame(labels, LABELS)
    model, bad = quality.fit(docs, table)
    out = quality.score(docs, model, bad, 0.3).withColumnRenamed("id", "doc_id")
    rows = {x.doc_id: x for x in toxicity.with_fold(out, 0.3).collect()}
    assert len(rows) == 303 and all(0 <= x.score <= 1 for x in rows.values())
    held = [(rows[i].score, g) for i, g, _ in labels if rows[i].held_out]
    assert min(s for s, g in held if g) > max(s for s, g in held if not g)
    assert abs(np.mean([x.predicted == 0 for x in rows.values()]) - bad) < 0.03
    assert rows[300].score == rows[301].score


def test_quality_without_labels_or_rows(spark):
    docs = frame(spark, ["a b", None])
    model, bad = quality.fit(docs, spark.createDataFrame([], LABELS))
    got = [x.score for x in quality.score(docs, model, bad, 0.3).collect()]
    assert np.allclose(got, 0.3)
    assert quality.score(docs.limit(0), model, bad, 0.3).count() == 0


def test_held_out_null(spark):
    df = spark.createDataFrame([(None,), (1,)], "doc_id bigint").select(is_held_out(F.col("doc_id")))
    assert [r[0] for r in df.collect()][0] is False


def test_strengths_from_pairs_again():
    """The model against the loss's own minimum, from the features on; a number
    of good rows that divides the old stride changes nothing."""
    import numpy as np
    from measures.llm.quality import FEATURES, PAIRS, RIDGE, BradleyTerry, expand
    r = np.random.Generator(np.random.PCG64(2))
    for n_good in (7919, 7920):
        y = np.concatenate([np.ones(n_good, int), np.zeros(40, int)])
        x = np.abs(r.normal(size=(len(y), len(FEATURES)))) + 0.4 * y[:, None]
        model = BradleyTerry(x, y)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        turn = np.arange(len(bad) * PAIRS)
        stride = 7919 if n_good % 7919 else 7920
        z = expand(x)
        z = (z - z.mean(axis=0)) / np.maximum(z.std(axis=0), 1e-9)
        diff = z[good[turn * stride % n_good]] - z[bad[turn % len(bad)]]
        assert len(set(turn * stride % n_good)) > 30
        grad = diff.T @ (1 / (1 + np.exp(-diff @ model.w)) - 1) / len(diff) + RIDGE * model.w
        assert np.abs(grad).max() < 1e-4
        won = (model.strength(x)[good][:40, None] > model.strength(x)[bad][None, :]).mean()
        assert won > 0.7


def test_toxicity_learned_from_empty_texts_only(spark):
    docs = frame(spark, [None, "", " ", None, "", "word"], list(range(1, 7)))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 6)], LABELS)
    index = toxicity.fit(docs, labels)
    assert {r.score for r in toxicity.score(docs, index).collect()} == {index.base_rate}
