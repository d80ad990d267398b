"""The mix of more sources than a broadcast plan holds."""

import random

import pytest
from test_mixing import SCHEMA, simulate

from measures.llm.mixing import mix


@pytest.mark.parametrize("default", [1, 2])
def test_rows_give_the_same_schedule(spark, default):
    rng = random.Random(default)
    names = [None, "", "a", "b", "c", "m", "z"] + [f"s{i}" for i in range(30)]
    sources = [s for s in names for _ in range(rng.choice([1, 3, 9, 30, 70]))]
    shares = {"a": 5, "b": 3, "m": 2, "s7": 4, "z": 1, "absent": 3}
    df = spark.createDataFrame(list(enumerate(sources)), SCHEMA).repartition(5)
    got = mix(df, shares, default, block_rows=2, max_plan_slots=0).collect()
    counts = {s: sources.count(s) for s in names}
    every = {s: shares.get(s, default) for s in names}
    assert sorted(r.id for r in got) == list(range(len(sources)))
    assert {(r.source, r.block): r.slot for r in got} == simulate(counts, every, 2)
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_thousands_of_sources(spark):
    rows = [(i, f"host{i % 2500}") for i in range(6000)]
    got = mix(spark.createDataFrame(rows, SCHEMA), {"host3": 6}, block_rows=1).collect()
    assert sorted(r.id for r in got) == list(range(6000))
    assert len({(r.slot, r.place) for r in got}) == 6000
    assert all(r.release <= r.slot < r.deadline for r in got)
