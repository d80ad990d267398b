"""The secret scan against regular expressions and windows counted one by one."""

import math
import re
from collections import Counter

import pytest

from helpers import frame, rng
from measures.llm import secrets as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text)
            if len(m[0]) >= 24]
    return sorted(out)


def added(text, classes=S.CLASSES):
    out = []
    for number, c in enumerate(classes, 3):
        for m in re.finditer(f"[{c.members}]+", text or ""):
            run, spans = m[0].lower() if c.fold else m[0], []
            if any(re.search(p, m[0]) for p in S.ALLOW_WHOLE):
                continue
            for a in range(len(run) - c.window + 1):
                counts = Counter(run[a:a + c.window]).values()
                if sum(round(1e6 * n * math.log2(n)) for n in counts) <= c.most:
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = a + c.window
                    else:
                        spans.append([a, a + c.window])
            out += [(m.start() + a, number, c.kind, m.start() + b) for a, b in spans
                    if not any(re.search(p, m[0][a:b]) for p in S.ALLOW_PART)]
    return sorted(out)


def check(spark, texts):
    found = {r.id: r for r in S.find_secrets(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in found[i].base] == base(t), t
        assert [tuple(s) for s in found[i].added] == added(t), t


def test_random_texts(spark):
    r = rng(3)
    pieces = ["token", "PassWord", "api_key", "apikey", "secret", "=", ": ", '"', "'", " ", "AKIA",
              "é", "😀", "\n", "ſecret", "toKen=", "example", "-", "/"]
    texts = [None, ""]
    for _ in range(150):
        parts = []
        for _ in range(r.randint(1, 25)):
            kind = r.random()
            if kind < 0.55:
                parts.append(r.choice(pieces))
            else:
                letters = r.choice(["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                                    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/",
                                    "ab", "0123456789abcdefABCDEF"])
                parts.append("".join(r.choice(letters) for _ in range(r.randint(1, 45))))
        texts.append("".join(parts))
    check(spark, texts)


def test_a_failing_assignment_hides_what_it_covers(spark):
    check(spark, ["secret=token: abcdefgh", "secret=tokens: abcdefgh", "token==abcde", "token=abcde",
                  "token=token=abcdef", "api_key : 'abc.def-ghi'"])


def test_allow_list_suppresses_added_spans_only(spark):
    uuid = "550e8400-e29b-41d4-a716-446655440000"
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    found = {r.id: r for r in S.find_secrets(frame(spark, [
        f"id {uuid}", f"sum {empty}", "see aB3dE5gH7jK9mN1pQ3exampleX7zA2cF4",
        "see aB3dE5gH7jK9mN1pQ3sT5vX7zA2cF4"])).collect()}
    assert [len(found[i].added) for i in range(4)] == [0, 0, 0, 1]
    assert [len(found[i].base) for i in range(4)] == [0, 1, 0, 0]
    own = S.find_secrets(frame(spark, ["see aB3dE5gH7jK9mN1pQ3sT5vX7zA2cF4"]),
                         allow_whole=["^aB3"]).head()
    assert own.added == []


def test_long_texts_and_very_many_matches(spark):
    r = rng(5)
    run = "".join(r.choice("0123456789abcdef") for _ in range(30_000))
    many = " ".join("".join(r.choice("0123456789abcdef") for _ in range(26)) for _ in range(1500))
    check(spark, [run, many, "a" * 50_000, "é" * 1000 + " token=abcdefgh"])


def test_repeated_rows_null_ids_empty_tables_clashing_columns(spark):
    rows = [(1, "token=abcdef", "x", 1, 2), (1, "token=abcdef", "x", 1, 2), (None, None, "y", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, base int, added int")
    found = S.find_secrets(docs).collect()
    assert sorted((r.id or 0, len(r.base)) for r in found) == [(0, 0), (1, 1), (1, 1)]
    assert S.find_secrets(docs.limit(0)).collect() == []


def test_no_python_and_no_shuffle(spark):
    plan = S.find_secrets(frame(spark, ["x"]).coalesce(1))._jdf.queryExecution().optimizedPlan()
    assert "Python" not in plan.toString() and "Arrow" not in plan.toString()


@pytest.mark.parametrize("kind", S.CLASSES, ids=lambda c: c.kind)
def test_limit_is_the_entropy(kind):
    assert abs(math.log2(kind.window) - kind.most / 1e6 / kind.window - kind.bits) < 1e-6
