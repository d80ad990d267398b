"""Pfair mixing against a slot-by-slot simulation."""

import random

from measures.llm.mixing import mix

SCHEMA = "doc_id bigint, source string"


def simulate(counts, shares, block_rows):
    """{(source, block): slot} by earliest deadline first, period by period."""
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    order = sorted(blocks, key=lambda s: "" if s is None else "=" + s)
    out, period, base = {}, 0, 0
    while live := [s for s in order if blocks[s] > period * shares[s]]:
        size, had = sum(shares[s] for s in live), dict.fromkeys(live, 0)
        for t in range(size):
            due = [(-(-(had[s] + 1) * size // shares[s]), i) for i, s in enumerate(live)
                   if had[s] < shares[s] and had[s] * size // shares[s] <= t]
            s = live[min(due)[1]]
            had[s] += 1
            block = period * shares[s] + had[s]
            if block <= blocks[s]:
                out[s, block] = base + t
        base, period = base + size, period + 1
    return out


def test_schedule_and_deviation(spark):
    rng = random.Random(3)
    sources = ["a"] * 300 + ["b"] * 90 + ["c"] * 80 + [None] * 40 + ["d"] * 1
    rows = [(i, s) for i, s in enumerate(sources)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    shares = {"a": 5, "b": 3, "c": 2}
    got = mix(df, shares, default_share=1, block_rows=4).collect()
    assert sorted(r.id for r in got) == list(range(len(sources)))
    counts = {s: sources.count(s) for s in set(sources)}
    every = {s: shares.get(s, 1) for s in counts}
    assert {(r.source, r.block): r.slot for r in got} == simulate(counts, every, 4)
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert len({(r.slot, r.place) for r in got}) == len(got)
    # Until the first source runs out, no source is a block away from its share.
    total, first_end = sum(every.values()), sum(every.values()) * min(
        counts[s] // 4 // e for s, e in every.items() if counts[s] >= 4)
    owner = {r.slot: r.source for r in got}
    had = dict.fromkeys(every, 0)
    for t in range(min(first_end, min(-(-counts[s] // 4) for s in every) * total)):
        if t in owner:
            had[owner[t]] += 1
        assert all(abs(had[s] - (t + 1) * e / total) < 1 for s, e in every.items())


def test_null_ids_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(None, "a")] * 5 + [(1, "a")] * 3 + [(2, None)], SCHEMA)
    got = mix(df, {}, block_rows=2).collect()
    assert len(got) == 9 and len({(r.slot, r.place) for r in got}) == 9
    assert mix(df.limit(0), {}, block_rows=2).count() == 0


def test_no_python_in_the_plan(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        mix(spark.createDataFrame([(1, "a")], SCHEMA).where("doc_id > 0"), {}).explain()
    assert "Python" not in buf.getvalue() and "Cartesian" not in buf.getvalue()
