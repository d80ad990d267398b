"""Common terms are added only where they can matter, and the nearest stay exact."""

import numpy as np

from measures.llm import toxicity


def zipf_index(n=3000, n_terms=4000, seed=5):
    """Examples of some 40 terms each, a few of them in most examples."""
    r = np.random.Generator(np.random.PCG64(seed))
    texts = [np.unique(np.minimum(r.zipf(1.3, 60) - 1, n_terms - 1), return_counts=True)
             for _ in range(n)]
    texts[7] = texts[2000]  # ties go to the smaller id
    vocabulary = toxicity.Vocabulary(np.arange(n_terms, dtype=np.uint64), np.ones(n_terms, np.int64),
                                     np.where(np.arange(n_terms) % 50 == 9, 100.0, 1.0))
    ids = r.permutation(n) * 3
    return texts, toxicity.NeighbourIndex(
        vocabulary, ids, np.arange(n) % 2, np.append(0, np.cumsum([len(t) for t, _ in texts])),
        np.concatenate([t for t, _ in texts]), np.concatenate([c for _, c in texts]), n, 0.5)


def test_nearest_equal_brute_force_with_few_common_terms_added():
    texts, index = zipf_index()
    dense = np.zeros((len(index.ids), len(index.idf)))
    dense[index.post_rank, index.post_term] = index.post_weight
    place, rows, norms = index.common
    assert 0 < rows.shape[1] < 40 and rows.size * toxicity.COMMON <= len(index.post_term)
    asked = []

    class Rows(np.ndarray):
        def __getitem__(self, at):
            asked.append(len(at))
            return np.asarray(self)[at]

    index.common = place, rows.view(Rows), norms
    for terms, counts in texts[:200]:
        q = index.unit(terms, counts)
        cosines = dense[:, terms] @ q
        want = np.lexsort((index.ids, -np.round(cosines, 12)))[:16]
        ranks, got = index.nearest(terms, q, 16)
        assert np.allclose(got, np.minimum(cosines[want], 1))
        assert index.ids[ranks].tolist() == index.ids[want].tolist()
    assert np.mean(asked) < len(index.ids) / 4
