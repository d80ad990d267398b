"""Constraint, report and ledger operators."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import F1_JOB, F1_ROWS, csv_text, write_file
from measures.operators import constraints, ledger, validate
from measures.plans import loading
from measures.sources.store import Store

FACTS = ("id string, study_id string, participant_id string, site_id string, "
         "measurement_type string, value_num double, bp_systolic int")


def test_fk_orphans(spark):
    facts = spark.createDataFrame([("1", "S1", "P1", "A", "glucose", 1.0, None),
                                   ("2", "S9", "P1", "Z", "glucose", 1.0, None)], FACTS)
    studies = spark.createDataFrame([("S1",)], "study_id string")
    sites = spark.createDataFrame([("A",)], "site_id string")
    participants = spark.createDataFrame([("P1",)], "participant_id string")
    enroll = spark.createDataFrame([("P1", "S1", dt.datetime(2024, 1, 1))],
                                   "participant_id string, study_id string, enrolled_at timestamp_ntz")
    got = dict(constraints.fk_orphans(facts, studies, sites, participants, enroll).collect())
    assert got == {"measurement.study_id -> studies": 1, "measurement.site_id -> sites": 1,
                   "measurement.(participant_id, study_id) -> enrollments": 1,
                   "enrollment.participant_id -> participants": 0,
                   "enrollment.study_id -> studies": 0}


def test_cascade_delete(spark):
    tables = {
        "studies": spark.createDataFrame([("S1",), ("S2",)], "study_id string"),
        "measurements": spark.createDataFrame([("1", "S1", "P1", "A", "glucose", 1.0, None),
                                               ("2", "S2", "P1", "A", "glucose", 1.0, None)], FACTS),
        "enrollments": spark.createDataFrame([("P1", "S1", dt.datetime(2024, 1, 1)),
                                              ("P1", "S2", dt.datetime(2024, 1, 1))],
                                             "participant_id string, study_id string, "
                                             "enrolled_at timestamp_ntz"),
        "jobs": spark.createDataFrame([("j1", "S1"), ("j2", "S2")], "job_id string, study_id string"),
    }
    gone = spark.createDataFrame([("S1",)], "k string")
    out = constraints.cascade_delete(tables, studies=gone)
    assert [r[0] for r in out["studies"].collect()] == ["S2"]
    assert [r.id for r in out["measurements"].collect()] == ["2"]
    assert [r.study_id for r in out["enrollments"].collect()] == ["S2"]
    assert sorted((r.job_id, r.study_id) for r in out["jobs"].collect()) == [("j1", None),
                                                                            ("j2", "S2")]


def test_range_report_is_report_only(spark):
    facts = spark.createDataFrame([("1", "S", "P", "A", "glucose", 50.0, None),
                                   ("2", "S", "P", "A", "glucose", 100.0, None),
                                   ("3", "S", "P", "A", "blood_pressure", None, 130),
                                   ("4", "S", "P", "A", "heart_rate", None, None)], FACTS)
    got = {r.measurement_type: (r.readings, r.below_range, r.above_range)
           for r in validate.range_report(facts).collect()}
    assert got["glucose"] == (2, 1, 0)
    assert got["blood_pressure"] == (1, 0, 1)
    assert got["heart_rate"] == (0, None, None)


def test_submit_then_load_ledger(spark, workdir):
    store = Store(os.path.join(workdir, "store"))
    loading.submit_jobs(spark, store, [{"job_id": F1_JOB, "filename": f"{F1_JOB}_s.csv",
                                         "study_id": "STUDY777"}])
    assert [r[0] for r in store.read(spark, "studies").collect()] == ["STUDY777"]
    pending = ledger.job_by_id(store.jobs(spark), F1_JOB).first()
    assert pending.status == "pending" and pending.study_id == "STUDY777"
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_s.csv", csv_text(F1_ROWS))
    loading.run_load(spark, land, store, manifest=[{"job_id": F1_JOB,
                                                     "filename": f"{F1_JOB}_s.csv",
                                                     "study_id": "STUDY777"}])
    job = ledger.job_by_id(store.jobs(spark), F1_JOB).first()
    assert (job.status, job.study_id, job.filename) == ("completed", "STUDY777", f"{F1_JOB}_s.csv")
    assert job.created_at <= job.updated_at and job.completed_at == job.updated_at
    history = [(r.status, r.progress, r.message) for r in
               store.jobs(spark).where(F.col("job_id") == F1_JOB).orderBy("event_at", "seq")
               .collect()]
    assert history == [("pending", 0, None), ("running", 0, "Job started"),
                       ("running", 10, "Extracted 12 rows"), ("running", 30, "Data transformed"),
                       ("running", 50, "Validation passed"), ("running", 90, "Loaded into DB"),
                       ("completed", 100, "Job completed successfully")]


def pending(spark, job_ids, at):
    jobs = spark.createDataFrame([(j, None, None) for j in job_ids],
                                 "job_id string, filename string, study_id string")
    return ledger.pending_events(jobs, at)


def test_live_status_overrides_stored(spark):
    at = dt.datetime(2024, 1, 1)
    stored = pending(spark, ["j1", "j2"], at)
    live = spark.createDataFrame([("j1", "running", 30, "Data transformed")],
                                 "job_id string, status string, progress int, message string")
    got = {r.job_id: (r.status, r.progress, r.message)
           for r in ledger.job_status(stored, live).collect()}
    assert got == {"j1": ("running", 30, "Data transformed"), "j2": ("pending", 0, None)}


def test_compact_ledger_keeps_history(spark, workdir):
    import glob

    from measures.sinks import tables
    store = Store(os.path.join(workdir, "store"))
    day1 = dt.datetime(2024, 1, 1, 8)
    for i in range(3):
        with tables.committing(spark, store) as commit:
            tables.append_ledger(commit, pending(spark, [f"j{i}"], day1 + dt.timedelta(hours=i)))
    with tables.committing(spark, store) as commit:
        tables.append_ledger(commit, pending(spark, ["j9"], dt.datetime(2024, 1, 2, 8)))
    before = sorted((r.job_id, r.event_at) for r in store.jobs(spark).collect())
    files = lambda: len([f for folder in store.folders(spark, "jobs") if "2024-01-01" in folder
                         for f in glob.glob(os.path.join(store.path("jobs"), folder, "*.parquet"))])
    assert files() == 3
    assert tables.compact_ledger(spark, store, before=dt.date(2024, 1, 3)) == 1
    assert files() == 1
    assert sorted((r.job_id, r.event_at) for r in store.jobs(spark).collect()) == before
    assert tables.compact_ledger(spark, store, before=dt.date(2024, 1, 3)) == 0
