"""The persistent digest index."""

import uuid

from helpers import frame
from measures.llm.exact_dedup import DigestIndex


def decide(df):
    return {r.id: (r.keep_id, r.group_size, r.kept) for r in df.collect()}


def test_batches_and_replay(spark):
    index = DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=4)
    first = frame(spark, ["a", "b", "a", None, "", "a ", "x" * 300_000])
    want = {0: (2, 2, False), 2: (2, 2, True), 1: (1, 1, True), 3: (4, 2, False),
            4: (4, 2, True), 5: (5, 1, True), 6: (6, 1, True)}
    assert decide(index.ingest(first)) == want
    assert index.read().count() == 5
    assert decide(index.ingest(first)) == want  # a replay adds nothing
    assert index.read().count() == 5
    second = frame(spark, ["a", "new", "new"], [100, 101, 102])
    assert decide(index.ingest(second)) == {100: (2, 1, False), 101: (102, 2, False),
                                            102: (102, 2, True)}
    # The same table, found again by name.
    assert DigestIndex(spark, index.name).read().count() == 6


def test_null_and_repeated_ids_and_empty(spark):
    index = DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=2)
    df = frame(spark, ["a", "a", "a", "n", "n"], [None, 1, 1, None, None])
    got = sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in index.ingest(df).collect()), key=str)
    assert got == sorted([(None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True),
                          (None, None, 2, True), (None, None, 2, True)], key=str)
    assert index.ingest(df.limit(0)).count() == 0


def test_new_data_reads_the_index_without_a_shuffle(spark):
    import contextlib
    import io
    index = DigestIndex(spark, f"digests_{uuid.uuid4().hex}", buckets=8)
    index.ingest(frame(spark, ["a"]))
    buf = io.StringIO()
    probe = index.read().select("digest").distinct()
    with contextlib.redirect_stdout(buf):
        probe.hint("merge").join(index.read(), "digest", "left_anti").explain()
    assert "Exchange" not in buf.getvalue()
