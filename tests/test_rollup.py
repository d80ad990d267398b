"""Roll-up merges: the faithful rule's NULL behaviour (T11-T14) and the
exact merge equal to a recompute for any split (property test)."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from measures.operators import rollup
from measures.schema import ROLLUP_KEYS

ROLL_COLS = ("agg_day date, study_id string, site_id string, participant_id string, "
             "measurement_type string, measurement_count long, avg_value double, "
             "min_value double, max_value double, avg_systolic double, avg_diastolic double, "
             "avg_quality_score double, low_quality_count long")
KEY = (dt.date(2024, 1, 15), "S", "A", "P", "glucose")


def bucket(spark, count, avg, mn, mx, sys_, dia, q, low):
    return spark.createDataFrame([(*KEY, count, avg, mn, mx, sys_, dia, q, low)], ROLL_COLS)


def test_faithful_merge_nulls(spark):
    old = bucket(spark, 2, None, None, None, None, None, 0.9, 1)
    new = bucket(spark, 1, 100.0, 100.0, 100.0, 120.0, 80.0, None, None)
    r = rollup.merge_faithful(old, new).first()
    assert r.measurement_count == 3
    assert r.avg_value is None                 # NULL old average poisons the merge
    assert (r.min_value, r.max_value) == (100.0, 100.0)  # LEAST/GREATEST skip NULL
    assert r.avg_systolic is None              # falls back to the old (NULL) average
    assert r.avg_quality_score is None and r.low_quality_count is None


def test_faithful_merge_keeps_old_systolic(spark):
    old = bucket(spark, 1, None, None, None, 120.0, 80.0, 0.9, 1)
    new = bucket(spark, 1, None, None, None, None, None, 0.9, 0)
    r = rollup.merge_faithful(old, new).first()
    assert (r.avg_systolic, r.avg_diastolic) == (120.0, 80.0)
    assert r.avg_quality_score == 0.9 and r.low_quality_count == 1


def test_faithful_merge_weights_by_count(spark):
    old = bucket(spark, 3, 10.0, 5.0, 20.0, None, None, 0.9, 0)
    new = bucket(spark, 1, 30.0, 30.0, 30.0, None, None, 0.5, 1)
    r = rollup.merge_faithful(old, new).first()
    assert r.avg_value == 15.0 and r.max_value == 30.0 and r.low_quality_count == 1
    assert abs(r.avg_quality_score - 0.8) < 1e-12


def test_one_sided_buckets_verbatim(spark):
    old = bucket(spark, 2, 1.0, 1.0, 1.0, None, None, None, None)
    other = spark.createDataFrame([(dt.date(2024, 1, 16), "S", "A", "P", "glucose", 1, 2.0, 2.0,
                                    2.0, None, None, 0.99, 0)], ROLL_COLS)
    got = sorted(tuple(r) for r in rollup.merge_faithful(old, other).collect())
    assert len(got) == 2 and got[0][5] == 2 and got[1][5] == 1


FACT_COLS = ("study_id string, site_id string, participant_id string, measurement_type string, "
             "timestamp timestamp_ntz, value_num double, bp_systolic int, bp_diastolic int, "
             "quality_score decimal(3,2)")

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["P1", "P2"]), st.integers(0, 2), st.integers(0, 47),
              st.one_of(st.none(), st.integers(0, 300)), st.one_of(st.none(), st.integers(0, 100)),
              st.booleans()),
    min_size=1, max_size=30)


@settings(max_examples=8, deadline=None)
@given(rows=rows_strategy)
def test_exact_merge_equals_recompute(spark, rows):
    data = []
    for i, (p, day, hour, val, q, first) in enumerate(rows):
        ts = dt.datetime(2024, 1, 1 + day, hour % 24, i % 60)
        data.append(("S", "A", p, "glucose", ts, None if val is None else float(val), None, None,
                     None if q is None else Decimal(q) / 100, first))
    df = spark.createDataFrame(data, FACT_COLS + ", first boolean")
    a, b = df.where("first"), df.where("NOT first")
    merged = rollup.finalize_partials(
        rollup.merge_exact(rollup.rollup_partials(a), rollup.rollup_partials(b)))
    direct = rollup.daily_rollup(df)

    def norm(d):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                      for r in d.select(*ROLLUP_KEYS, *rollup.MEASURES).collect())
    assert norm(merged) == norm(direct)
    # Without NULLs, the faithful rule gives the same as a recompute.
    if all(v is not None and q is not None for _, _, _, v, q, _ in rows):
        faithful = rollup.merge_faithful(rollup.daily_rollup(a), rollup.daily_rollup(b))
        assert norm(faithful) == norm(direct)


def test_latest_value_tie_break(spark):
    from measures.plans.analytics import latest_value
    df = spark.createDataFrame(
        [("P1", dt.datetime(2024, 1, 1), "a", 1.0), ("P1", dt.datetime(2024, 1, 2), "b", 2.0),
         ("P1", dt.datetime(2024, 1, 2), "c", 3.0), ("P2", dt.datetime(2024, 1, 1), "d", 4.0)],
        "participant_id string, timestamp timestamp_ntz, id string, value_num double")
    got = dict(latest_value(df, ["participant_id"], "value_num", ["timestamp", "id"], "v")
               .select("participant_id", "v").collect())
    assert got == {"P1": 3.0, "P2": 4.0}
    assert F is not None
