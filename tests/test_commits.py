"""Loads as commits: crashes at every step, jobs and headers without the driver,
conflicts in rounds, deletions, compaction, streams over committed data."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import F1_JOB, F1_ROWS, F2_JOB, F2_ROWS, HEADER, csv_text, write_file
from measures.operators import constraints, ledger, rollup
from measures.operators.ordering import with_position
from measures.plans import loading
from measures.plans.scenarios import Crash, crash_at
from measures.schema import ROLLUP_KEYS
from measures.sinks import tables
from measures.sources import landing
from measures.sources.store import Store
from measures.streaming.ingest import ingest_pending
from measures.streaming.rollup import merge_new_facts


def content(spark, store):
    facts = sorted(r.id for r in store.measurements(spark).collect())
    roll = sorted(tuple(r) for r in store.rollup(spark).select(*ROLLUP_KEYS, *rollup.MEASURES)
                  .collect())
    people = sorted(tuple(r) for r in store.enrollments(spark).collect())
    return facts, roll, people


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("clean"))
    write_file(f"{base}/l1", f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    write_file(f"{base}/l2", f"{F2_JOB}_b.csv", csv_text(F2_ROWS))
    store = Store(f"{base}/store")
    for folder in ("l1", "l2"):
        loading.run_load(spark, f"{base}/{folder}", store)
    return base, store


def test_a_crash_at_any_step_and_a_retry_under_a_new_id(spark, clean, workdir):
    base, whole = clean
    store = Store(f"{workdir}/store")
    loading.run_load(spark, f"{base}/l1", store)
    before = content(spark, store)
    for step in loading.STEPS:
        with pytest.raises(Crash):
            loading.run_load(spark, f"{base}/l2", store, on_step=crash_at(step))
        assert content(spark, store) == before
    loading.run_load(spark, f"{base}/l2", store)
    assert content(spark, store) == content(spark, whole)
    assert store.vacuum(spark) > 0  # what the crashed loads left
    assert content(spark, store) == content(spark, whole)


def test_two_commits_on_one_version_do_not_both_appear(spark, clean):
    _, store = clean
    first, second = store.begin(spark), store.begin(spark)
    facts = store.measurements(spark)
    tables.append_facts(first, facts.limit(1))
    tables.append_facts(second, facts.limit(1))
    n = facts.count()
    assert first.publish() == second.base.version + 1
    with pytest.raises(RuntimeError, match="another commit"):
        second.publish()
    assert store.measurements(spark).count() == n + 1
    assert store.at(second.base.version).measurements(spark).count() == n
    again = store.begin(spark)  # leave the fixture as it was
    again.kept = {t: list(f) for t, f in store.at(second.base.version).snapshot(spark).tables.items()}
    again.publish()


def test_first_accepted_equals_taking_jobs_one_by_one(spark):
    r = random.Random(3)
    for _ in range(3):
        jobs = {f"j{i:02d}": {f"k{r.randint(0, 40)}" for _ in range(r.randint(1, 4))}
                for i in range(25)}
        taken, lost = set(), set()
        for job, keys in jobs.items():
            if keys & taken:
                lost.add(job)
            else:
                taken |= keys
        edges = spark.createDataFrame(
            [("s", k, j, i) for i, (j, keys) in enumerate(jobs.items()) for k in keys],
            "study_id string, id string, job_id string, rank int")
        assert {x.job_id for x in constraints.first_accepted(edges).collect()} == lost


def test_a_job_sent_again_with_other_values_is_rejected(spark, workdir):
    header = "id," + HEADER
    row = "{i},STUDY009,P001,glucose,{v},mg/dL,2024-01-15T09:30:00Z,SITE_A,0.98"
    one = "0f8fad5b-d9cb-469f-a165-70867728950e"
    store = Store(f"{workdir}/store")
    for i, (value, status) in enumerate((("95.5", "completed"), ("95.5", "completed"),
                                         ("99", "failed"))):
        write_file(f"{workdir}/l{i}", f"{F1_JOB}_x.csv", header + "\n" + row.format(i=one, v=value))
        report = loading.run_load(spark, f"{workdir}/l{i}", store)
        assert report.status() == {F1_JOB: status}
    assert "with other values" in report.jobs.head().message
    assert [r.value for r in store.measurements(spark).collect()] == ["95.5"]


def test_many_headers_are_one_scan(spark, workdir):
    names = HEADER.split(",")
    r = random.Random(5)
    rows = F2_ROWS.splitlines()
    for i in range(40):
        order = r.sample(range(len(names)), len(names))
        extra = [f"x{j}" for j in range(i % 7)]
        line = ",".join([names[k] for k in order] + extra)
        body = "\n".join(",".join([row.split(",")[k] for k in order] + ["e"] * len(extra))
                         for row in rows)
        write_file(f"{workdir}/land", f"{i:08d}-0000-0000-0000-000000000000_f.csv",
                   line + "\n" + body + "\n")
    scan = landing.scan(spark, f"{workdir}/land")
    plan = scan.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1 and "Union" not in plan
    key = lambda df: sorted(tuple(x) for x in df.select(*names).collect())
    assert key(scan.rows) == sorted(tuple(x.split(",")) for x in rows * 40)
    assert not any(x._too_long for x in scan.rows.select(*names, "_too_long").collect())


def test_too_long_rows_among_narrow_and_wide_headers(spark, workdir):
    narrow, wide = HEADER, HEADER + ",a,b"
    row = F1_ROWS.splitlines()[0]
    write_file(f"{workdir}/land", "a.csv", narrow + "\n" + row + "\n" + row + ",1,2\n")
    write_file(f"{workdir}/land", "b.csv", wide + "\n" + row + ",1,2\n" + row + ",1,2,3\n")
    write_file(f"{workdir}/land", "c+d.csv", narrow + "\n" + row + ",1\n")
    rows = landing.scan(spark, f"{workdir}/land").rows
    got = sorted((r.path.rsplit("/", 1)[1], r._too_long, r.study_id) for r in rows.collect())
    assert [(p[0], long) for p, long, _ in got] == [
        ("a", False), ("a", True), ("b", False), ("b", True), ("c", True)]
    assert {s for *_, s in got} == {"STUDY001"}


def test_ingestion_keeps_jobs_whole_and_sees_empty_files(spark, workdir):
    land, store = f"{workdir}/land", Store(f"{workdir}/store")
    bad = F2_ROWS.replace("heart_rate", "pulse")
    write_file(f"{land}/{F1_JOB}_a", "part-0.csv", csv_text(F1_ROWS))
    write_file(f"{land}/{F1_JOB}_a", "part-1.csv", csv_text(bad))
    write_file(f"{land}/{F2_JOB}_b", "part-0.csv", csv_text(F2_ROWS))
    empty = "eeeeeeee-0000-0000-0000-000000000001"
    open(os.path.join(land, f"{empty}_e.csv"), "w").close()
    assert ingest_pending(spark, land, store, "L", max_files=1) == 3
    jobs = {r.job_id: (r.status, r.message) for r in
            ledger.current_jobs(store.jobs(spark)).collect()}
    assert jobs[F1_JOB] == ("failed", "Invalid types: ['pulse']")
    assert jobs[F2_JOB][0] == "completed" and store.measurements(spark).count() == 9
    assert jobs[empty][0] == "failed" and jobs[empty][1].startswith("Extraction error")
    assert ingest_pending(spark, land, store, "L") == 0
    # A late file of a job: the whole job is judged, stored rows are not stored twice.
    more = F2_ROWS.replace("2024-01-16", "2024-01-17")
    write_file(f"{land}/{F2_JOB}_b", "part-1.csv", csv_text(more))
    assert ingest_pending(spark, land, store, "M") == 1
    assert store.measurements(spark).count() == 18
    assert ingest_pending(spark, land, store, "N", settle_seconds=3600) == 0


def test_roll_up_stream_follows_late_rows_and_rewrites(spark, workdir):
    source, target = Store(f"{workdir}/facts"), Store(f"{workdir}/roll")
    lines = F1_ROWS.splitlines()
    for i in range(2):
        write_file(f"{workdir}/l{i}", f"{i}1a6d6f4-52a1-4f0e-9a5e-0c1d2e3f4a51_x.csv",
                   csv_text("\n".join(lines[i::2])))
        loading.run_load(spark, f"{workdir}/l{i}", source)
        assert merge_new_facts(spark, source, target, f"b{i}") > 0
    same = lambda: content(spark, target)[1] == sorted(
        tuple(r) for r in rollup.daily_rollup(source.measurements(spark))
        .select(*ROLLUP_KEYS, *rollup.MEASURES).collect())
    assert same() and merge_new_facts(spark, source, target, "none") == 0
    assert tables.compact(spark, source, "measurements") == 1
    people = spark.createDataFrame([("P001",)], "k string")
    tables.delete_keys(spark, source, participants=people)
    assert merge_new_facts(spark, source, target, "again") > 0
    assert same() and source.measurements(spark).where("participant_id = 'P001'").count() == 0


def test_cascade_rewrites_only_what_it_touches(spark, clean, workdir):
    base, _ = clean
    store = Store(f"{workdir}/store")
    for folder in ("l1", "l2"):
        loading.run_load(spark, f"{base}/{folder}", store)
    held = set(store.folders(spark, "measurements"))
    tables.delete_keys(spark, store, studies=spark.createDataFrame([("STUDY002",)], "k string"))
    left = set(store.folders(spark, "measurements"))
    assert left < held and {r.study_id for r in store.measurements(spark).collect()} == {"STUDY001"}
    assert [r[0] for r in store.read(spark, "studies").collect()] == ["STUDY001"]
    tables.delete_keys(spark, store, sites=spark.createDataFrame([("SITE_X",)], "k string"))
    assert set(store.folders(spark, "measurements")) == left


def test_positions_are_global(spark):
    rows = spark.range(0, 500).select((F.col("id") * 37 % 500).alias("v"), "id").repartition(7)
    got = with_position(rows, F.desc("v")).collect()
    assert len(got) == 500 and all(r.position == 500 - r.v for r in got)
    assert with_position(rows.limit(0), F.asc("v")).collect() == []


def test_a_load_at_a_given_instant(spark, clean, workdir):
    base, _ = clean
    store, at = Store(f"{workdir}/store"), dt.datetime(2024, 5, 6, 7)
    loading.run_load(spark, f"{base}/l1", store, instant=at)
    job = ledger.job_by_id(store.jobs(spark), F1_JOB).head()
    assert (job.created_at, job.completed_at) == (at, at)
    assert {r.processed_at for r in store.measurements(spark).collect()} == {at}
