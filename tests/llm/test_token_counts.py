"""The whole-token shortcut against the tokenizer itself."""

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import frame
from measures.llm.token_counts import count_tokens, counter, vocabulary_path

C = counter(vocabulary_path())


def library(text):
    return len(C.tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sSdlaé0²\x1c\x85\xa0<|>."), st.characters(
    max_codepoint=0x24F), st.characters(exclude_categories=["Cs"]))))
def test_equal_to_the_library(text):
    assert C.count(text) == library(text)


def test_special_strings_and_long_texts():
    for t in ("<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext", "日本語 text <|endoftext|>",
              "word " * 300_000, "x" * 3000, " \n" * 999):
        assert C.count(t) == library(t)


def test_rows(spark):
    df = frame(spark, [None, "", "héllo wörld", "a " * 2000])
    got = {r.id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df).collect()}
    n = library("a " * 2000)
    assert got == {0: (0, 0, False), 1: (0, 0, False), 2: (13, library("héllo wörld"), False),
                   3: (4000, n, n > 1024)}
    assert count_tokens(df.limit(0)).count() == 0


def test_whole_tokens_are_proved():
    assert len(C.costs.whole) > 40_000
    assert all(library(s) == 1 for s in C.costs.whole[::500])
