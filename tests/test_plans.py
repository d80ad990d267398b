"""Physical plan shape: filters reach the Parquet scan, partitions are pruned,
reads are top-k, aggregates combine before the shuffle, no Python in the
analytic plans."""

import io
import os
from contextlib import redirect_stdout

import pytest

from conftest import F1_JOB, F1_ROWS, F2_JOB, F2_ROWS, csv_text, write_file
from measures.operators import rollup
from measures.plans import analytics, loading, reads
from measures.sources.store import Store


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plans"))
    land = os.path.join(base, "landing")
    write_file(land, f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    write_file(land, f"{F2_JOB}_b.csv", csv_text(F2_ROWS))
    s = Store(os.path.join(base, "store"))
    loading.run_load(spark, land, s)
    return s


def test_reader_prunes_partition_and_pushes_filters(spark, store):
    p = plan(reads.query_measurements(store.measurements(spark), study_id="STUDY001",
                                      measurement_type="glucose", start_date="2024-01-15"))
    assert "TakeOrderedAndProject" in p
    assert "PartitionFilters: [isnotnull(study_id" in p and "= STUDY001)" in p
    assert "EqualTo(measurement_type,glucose)" in p and "GreaterThanOrEqual(timestamp" in p
    assert "job_id:" not in p.split("ReadSchema:")[1].splitlines()[0]


def test_rollup_aggregates_partially_and_prunes_columns(spark, store):
    p = plan(rollup.daily_rollup(store.measurements(spark)))
    assert p.count("HashAggregate") >= 2 and "Exchange" in p
    read_schema = p.split("ReadSchema:")[1].splitlines()[0].strip()
    fields = {f.split(":")[0] for f in read_schema[len("struct<"):-1].split(",")}
    assert "value" not in fields and "id" not in fields and "job_id" not in fields


def test_latest_value_is_an_aggregate_not_a_window(spark, store):
    p = plan(analytics.mean_bmi(store.measurements(spark), "STUDY001"))
    assert "Window" not in p
    assert "PartitionFilters: [isnotnull(study_id" in p


def test_no_python_in_analytic_plans(spark, store):
    facts, roll = store.measurements(spark), store.rollup(spark)
    for df in (analytics.quality_by_study(facts), analytics.mean_bmi_rollup(roll),
               analytics.recent_measurements(facts, 30, "2024-02-01"),
               rollup.merge_faithful(roll, rollup.daily_rollup(facts))):
        p = plan(df)
        assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_duplicate_check_prunes_stored_facts(spark, store):
    import datetime as dt

    from measures.operators.constraints import stored_ids_for
    stored = store.measurements(spark)
    windows = {"STUDY002": (dt.datetime(2024, 1, 16, 9), dt.datetime(2024, 1, 16, 12))}
    p = plan(stored_ids_for(stored, windows))
    assert "PartitionFilters: [" in p and "study_id" in p.split("PartitionFilters:")[1].splitlines()[0]
    assert "STUDY002" in p.split("PartitionFilters:")[1].splitlines()[0]
    pushed = p.split("PushedFilters:")[1].splitlines()[0]
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThanOrEqual(timestamp" in pushed
    read_schema = p.split("ReadSchema:")[1].splitlines()[0]
    assert "value_num" not in read_schema
