"""Repeated passages of 51 words are met wherever they start and end."""

from helpers import frame, rng, sentence
from measures.llm.sentence_spans import LONG, remove_repeated_spans


def run(spark, texts):
    got = remove_repeated_spans(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    return [r.kept for r in sorted(got, key=lambda r: r.id)]


def test_passages_planted_mid_sentence(spark):
    """All but the first lose the passage, up to LONG words at its ends; what
    stands around it stays."""
    r = rng(11)
    texts, parts = [], []
    for size in (51, 52, 55, 64, 80, 300) * 6:
        passage = sentence(r, size)
        if r.random() < 0.5:  # short whole sentences inside
            passage = passage.replace(" ", ". ", r.randint(1, 4)).replace(" ", ".\n", 1)
        for _ in range(3):
            before, after = sentence(r, r.randint(0, 30)), sentence(r, r.randint(0, 30))
            texts.append(f"{before} {passage} {after}.")
            parts.append((before, passage, after, size))
    kept = run(spark, texts)
    for i, (text, (before, passage, after, size)) in enumerate(zip(kept, parts)):
        left = len(text.split()) - len(before.split()) - len((after + ".").split())
        if i % 3 == 0:
            assert text == texts[i]
        else:
            assert left <= 2 * LONG + 1, (size, left, text)


def test_texts_without_white_space(spark):
    r = rng(12)
    signs = lambda n: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(n))
    passage = signs(80)
    texts = [signs(100) + passage + signs(90), signs(210) + passage, signs(300)]
    kept = run(spark, texts)
    assert kept[0] == texts[0] and kept[2] == texts[2]
    assert 210 <= len(kept[1]) <= 210 + 2 * LONG


def test_clean_texts_stay(spark):
    r = rng(13)
    texts = [". ".join(sentence(r, r.randint(2, 20)) for _ in range(30)) for _ in range(40)]
    assert run(spark, texts) == texts
