"""Different texts under one id keep the links of each."""

from helpers import frame, rng, sentence
from measures.llm import jaccard


def test_each_text_of_an_id_links(spark):
    r = rng(5)
    bases = [sentence(r, 60) for _ in range(4)]
    texts = [f"{x} {sentence(r, 1)}" for x in bases] + bases
    df = frame(spark, texts, [3] * 4 + [5, 6, 7, 8])
    got = sorted((x.id, x.component_id) for x in jaccard.jaccard_components(df).collect())
    assert got == [(3, 3)] * 4 + [(5, 3), (6, 3), (7, 3), (8, 3)]


def test_own_tokens_of_an_id_count(spark):
    r = rng(6)
    base = sentence(r, 60)
    texts = [f"{base} {sentence(r, n)}" for n in (14, 2)] + [base]  # 0.80 and 0.97 alike
    for ids in ([3, 3, 5], [3, 4, 5]):
        got = {x.id: x.component_id for x in jaccard.jaccard_components(
            frame(spark, texts, ids)).collect()}
        assert set(got.values()) == {3}
