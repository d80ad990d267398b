"""End to end: sample files -> tables -> queries, against FIXTURES golden values,
plus the per-file edge cases (whole-file accept/reject)."""

import datetime as dt
import hashlib
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import F1_JOB, F1_ROWS, F1B_JOB, F2_JOB, F2_ROWS, HEADER, csv_text, write_file
from measures.operators import ledger
from measures.plans import analytics, loading, reads
from measures.sources.store import Store


def id_of(text):
    return str(uuid.UUID(hashlib.md5(text.encode()).hexdigest()))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("e2e"))
    land = os.path.join(base, "landing")
    write_file(land, f"{F1_JOB}_sample_study001.csv", csv_text(F1_ROWS))
    write_file(land, f"{F2_JOB}_sample_study002.csv", csv_text(F2_ROWS))
    store = Store(os.path.join(base, "store"))
    report = loading.run_load(spark, land, store)
    return spark, store, report, base


def test_jobs_completed(loaded):
    _, _, report, _ = loaded
    assert report.status() == {F1_JOB: "completed", F2_JOB: "completed"}
    assert {j["job_id"]: j["rows"] for j in report.jobs.collect()} == {F1_JOB: 12, F2_JOB: 9}


def test_glucose_read_golden(loaded):
    spark, store, _, _ = loaded
    rows = reads.query_measurements(store.measurements(spark), api_layout=True,
                                    study_id="STUDY001", measurement_type="glucose").collect()
    assert [(r.id, r.participantId, r.value, r.timestamp, r.qualityScore) for r in rows] == [
        ("9ca1d38b-3d8f-4916-8368-402ea20bb85c", "P003", "88.2", "2024-01-15T11:00:00.000Z", "0.99"),
        ("a7bafe00-7016-aa63-a48e-a8bcb1c79d6f", "P002", "102.1", "2024-01-15T10:15:00.000Z", "0.97"),
        ("b5040dff-6f05-38d5-08ee-83a83cc26a9d", "P001", "95.5", "2024-01-15T09:30:00.000Z", "0.98")]


def test_queries_golden(loaded):
    spark, store, _, _ = loaded
    facts, roll = store.measurements(spark), store.rollup(spark)
    assert roll.count() == 21
    assert [tuple(r) for r in analytics.quality_by_study(facts).collect()] == [
        ("STUDY001", 0.974, 12), ("STUDY002", 0.957, 9)]
    assert [tuple(r) for r in analytics.quality_by_study_rollup(roll, digits=6).collect()] == [
        ("STUDY001", 0.974167, 12), ("STUDY002", 0.956667, 9)]
    assert [tuple(r) for r in analytics.daily_trend(facts, "P001", "glucose").collect()] == [
        (dt.date(2024, 1, 15), 95.5)]
    assert [tuple(r) for r in analytics.daily_trend_rollup(roll, "P001", "glucose").collect()] == [
        (dt.date(2024, 1, 15), 95.5)]
    assert [tuple(r) for r in analytics.counts_by_site(facts).collect()] == [
        ("SITE_A", 12), ("SITE_B", 9)]
    assert [tuple(r) for r in analytics.counts_by_site_rollup(roll).collect()] == [
        ("SITE_A", 12), ("SITE_B", 9)]
    low = analytics.low_quality_buckets(roll).collect()
    assert [(r.agg_day, r.study_id, r.participant_id, r.measurement_type,
             r.measurement_count, r.avg_systolic, r.avg_diastolic, r.avg_quality_score,
             r.low_quality_count) for r in low] == [
        (dt.date(2024, 1, 16), "STUDY002", "P001", "blood_pressure", 1, 118.0, 76.0, 0.91, 1),
        (dt.date(2024, 1, 16), "STUDY002", "P002", "blood_pressure", 1, 141.0, 92.0, 0.93, 1)]
    q6 = sorted(tuple(r) for r in
                analytics.participants_per_study(store.enrollments(spark)).collect())
    assert q6 == [("STUDY001", 3), ("STUDY002", 3)]
    assert analytics.mean_bmi(facts, "STUDY001").first()[0] == 23.38
    assert analytics.mean_bmi_rollup(roll, "STUDY001").first()[0] == 23.38
    recent = analytics.recent_measurements(facts, days=1, as_of=dt.date(2024, 1, 17)).count()
    assert recent == 9


def test_enrollments_golden(loaded):
    spark, store, _, _ = loaded
    got = sorted((r.study_id, r.participant_id, r.enrolled_at)
                 for r in store.enrollments(spark).collect())
    assert got == [("STUDY001", "P001", dt.datetime(2024, 1, 15, 9, 30)),
                   ("STUDY001", "P002", dt.datetime(2024, 1, 15, 10, 15)),
                   ("STUDY001", "P003", dt.datetime(2024, 1, 15, 11, 0)),
                   ("STUDY002", "P001", dt.datetime(2024, 1, 16, 9, 0)),
                   ("STUDY002", "P002", dt.datetime(2024, 1, 16, 12, 45)),
                   ("STUDY002", "P003", dt.datetime(2024, 1, 16, 14, 5))]


def test_dimensions(loaded):
    spark, store, _, _ = loaded
    assert sorted(r[0] for r in store.read(spark, "studies").collect()) == ["STUDY001", "STUDY002"]
    assert sorted(r[0] for r in store.read(spark, "sites").collect()) == ["SITE_A", "SITE_B"]
    assert sorted(r[0] for r in store.read(spark, "participants").collect()) == [
        "P001", "P002", "P003"]


def test_reader_filters(loaded):
    spark, store, _, _ = loaded
    facts = store.measurements(spark)
    # A bare end date means midnight: the 09:00 row of that day is excluded.
    assert reads.query_measurements(facts, end_date="2024-01-16").count() == 12
    assert reads.query_measurements(facts, study_id="", participant_id=None).count() == 21
    assert reads.query_measurements(facts, start_date="2024-01-16T09:00:00").count() == 9
    assert reads.study_exists(facts, "STUDY002") and not reads.study_exists(facts, "STUDY009")


def test_ledger_lookup(loaded):
    spark, store, _, _ = loaded
    job = ledger.job_by_id(store.jobs(spark), F1_JOB).first()
    assert job.status == "completed" and job.completed_at is not None
    assert job.filename == f"{F1_JOB}_sample_study001.csv"
    assert ledger.job_by_id(store.jobs(spark), "no-such-job").count() == 0
    api = ledger.job_by_id(store.jobs(spark), F1_JOB, api_layout=True).first().asDict()
    assert set(api) == {"id", "filename", "studyId", "status", "createdAt", "updatedAt",
                        "completedAt", "errorMessage"}
    assert api["completedAt"].endswith("Z") and api["errorMessage"] is None
    st = {r.job_id: (r.status, r.progress, r.message)
          for r in ledger.job_status(store.jobs(spark)).collect()}
    assert st[F2_JOB] == ("completed", 100, "Job completed successfully")


def test_second_copy_rejected_state_unchanged(loaded):
    spark, store, _, base = loaded
    land2 = os.path.join(base, "landing2")
    write_file(land2, f"{F1B_JOB}_sample_study001.csv", csv_text(F1_ROWS))
    before = store.rollup(spark).orderBy("agg_day", "participant_id", "measurement_type").collect()
    report = loading.run_load(spark, land2, store)
    assert report.status() == {F1B_JOB: "failed"}
    assert "duplicate key" in report.jobs.collect()[0]["message"]
    assert store.measurements(spark).count() == 21
    after = store.rollup(spark).orderBy("agg_day", "participant_id", "measurement_type").collect()
    assert before == after


def run_single(spark, workdir, name, text, manifest=None):
    land = os.path.join(workdir, "landing")
    if text is not None:
        write_file(land, name, text)
    else:
        os.makedirs(land, exist_ok=True)
        write_file(land, "00000000-0000-0000-0000-000000000000_other.csv", csv_text(F2_ROWS))
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store, manifest=manifest)
    return report, store


JOB = "11111111-2222-3333-4444-555555555555"


@pytest.mark.parametrize("rows,expect", [
    ("STUDY001,P001,pulse,72,bpm,2024-01-15T09:30:00Z,SITE_A,0.9\n" + F1_ROWS,
     "Invalid types: ['pulse']"),
    ("STUDY001,P001,glucose,95.5,mg/dL,15/01/2024,SITE_A,0.9\n" + F1_ROWS, "Transform error"),
    ("STUDY001,P001,glucose,,mg/dL,2024-01-15T09:30:00Z,SITE_A,0.9\n" + F1_ROWS,
     'null value in column "value"'),
    ("STUDY001,P001,glucose,n/a,mg/dL,2024-01-15T09:30:00Z,SITE_A,0.9\n" + F1_ROWS,
     'null value in column "value"'),
    ("STUDY002,P001,blood_pressure,99999999999/80,mmHg,2024-01-16T09:00:00Z,SITE_B,0.9\n" + F2_ROWS,
     "integer out of range"),
    ("STUDY001,P001,glucose,95.5,mg/dL,2024-01-15T09:30:00Z,SITE_A,0.9,extra\n" + F1_ROWS,
     "Extraction error"),
    (F1_ROWS + "\n" + F1_ROWS.splitlines()[0], "duplicate key"),
])
def test_file_rejected_whole(spark, workdir, rows, expect):
    report, store = run_single(spark, workdir, f"{JOB}_case.csv", csv_text(rows))
    job = next(j for j in report.jobs.collect() if j["job_id"] == JOB)
    assert job["status"] == "failed" and expect in job["message"], job
    assert store.read(spark, "measurements") is None


def test_file_accepted_with_soft_problems(spark, workdir):
    rows = ("STUDY001,P009,glucose,invalid,mg/dL,2024-01-15T09:30:00+02:00,SITE_A,abc\n"
            "STUDY001,P009,cholesterol, 180 ,mg/dL,2024-01-15T10:30:00Z, SITE_A ,0.949\n"
            "STUDY001,P009,weight,-5,kg,2024-01-15T11:30:00Z,SITE_A,\n"
            "STUDY001,P009,height,170,cm,2024-01-15T12:30:00Z,SITE_A")
    report, store = run_single(spark, workdir, f"{JOB}_case.csv", csv_text(rows))
    assert report.status()[JOB] == "completed"
    got = {r.measurement_type: r for r in store.measurements(spark).collect()}
    assert got["glucose"].timestamp == dt.datetime(2024, 1, 15, 7, 30)
    assert got["glucose"].value_num is None and got["glucose"].quality_score is None
    assert got["cholesterol"].value == " 180 " and got["cholesterol"].value_num == 180.0
    assert got["cholesterol"].site_id == "SITE_A" and str(got["cholesterol"].quality_score) == "0.95"
    assert got["weight"].value_num is None
    assert got["height"].quality_score is None  # short row padded with NULL
    roll = store.rollup(spark).where("measurement_type = 'cholesterol'").first()
    assert roll.low_quality_count == 0


def test_header_normalised_reordered_extra(spark, workdir):
    header = "Quality_Score, Site ID ,timestamp,UNIT,value,Measurement Type,participant_id,study_id,notes"
    body = "\n".join(",".join([r.split(",")[i] for i in (7, 6, 5, 4, 3, 2, 1, 0)] + ["x"])
                     for r in F2_ROWS.splitlines())
    report, store = run_single(spark, workdir, f"{JOB}_reordered.csv", header + "\n" + body + "\n")
    assert report.status()[JOB] == "completed"
    got = store.measurements(spark).where("measurement_type='heart_rate' AND participant_id='P001'")
    r = got.first()
    assert (r.value, r.site_id, str(r.quality_score)) == ("66", "SITE_B", "0.97")
    assert r.id == id_of("STUDY002|P001|2024-01-16 09:00:00+00:00|heart_rate|66")


def test_missing_column(spark, workdir):
    header = "study_id,participant_id,measurement_type,value,unit,site_id,quality_score"
    body = "STUDY001,P001,glucose,95.5,mg/dL,SITE_A,0.98"
    report, _ = run_single(spark, workdir, f"{JOB}_nots.csv", header + "\n" + body + "\n")
    assert report.jobs.collect()[0]["status"] == "failed"
    assert report.jobs.collect()[0]["message"] == "Missing column timestamp"


def test_file_not_found_from_manifest(spark, workdir):
    manifest = [{"job_id": JOB, "filename": f"{JOB}_gone.csv", "study_id": "STUDY001",
                 "created_at": dt.datetime(2024, 1, 1)}]
    report, store = run_single(spark, workdir, None, None, manifest=manifest)
    job = next(j for j in report.jobs.collect() if j["job_id"] == JOB)
    assert job["status"] == "failed" and job["message"] == f"File not found: {JOB}_gone.csv"


def test_batch_duplicates_first_job_wins(spark, workdir):
    land = os.path.join(workdir, "landing")
    a = "aaaaaaaa-0000-0000-0000-000000000001"
    b = "bbbbbbbb-0000-0000-0000-000000000002"
    c = "cccccccc-0000-0000-0000-000000000003"
    write_file(land, f"{a}_x.csv", csv_text(F1_ROWS))
    write_file(land, f"{b}_x.csv", csv_text(F1_ROWS.splitlines()[0] + "\n" + F2_ROWS))
    write_file(land, f"{c}_x.csv", csv_text(F2_ROWS))
    manifest = [{"job_id": j, "filename": f"{j}_x.csv", "created_at": dt.datetime(2024, 1, 1, 0, i)}
                for i, j in enumerate((a, b, c))]
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store, manifest=manifest)
    # b repeats a row of a (earlier) -> rejected; c repeats b's rows, but b was
    # not loaded, so c is accepted.
    assert report.status() == {a: "completed", b: "failed", c: "completed"}
    assert store.measurements(spark).count() == 21


def test_replayed_load_is_idempotent(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_s.csv", csv_text(F1_ROWS))
    store = Store(os.path.join(workdir, "store"))
    loading.run_load(spark, land, store, load_id="L1")
    again = loading.run_load(spark, land, store, load_id="L1")
    assert again.status() == {F1_JOB: "completed"}
    assert store.measurements(spark).count() == 12
    assert store.rollup(spark).agg(F.sum("measurement_count")).first()[0] == 12


def sums(spark, store):
    return (store.measurements(spark).count(),
            store.rollup(spark).agg(F.sum("measurement_count")).first()[0])


def test_same_job_sent_again_with_more_rows(spark, workdir):
    lines = F1_ROWS.splitlines()
    store = Store(os.path.join(workdir, "store"))
    for i, n in enumerate((1, 3, 3)):
        land = os.path.join(workdir, f"landing{i}")
        write_file(land, f"{F1_JOB}_s.csv", csv_text("\n".join(lines[:n])))
        assert loading.run_load(spark, land, store).status() == {F1_JOB: "completed"}
        assert sums(spark, store) == (n, n)


def test_replay_over_a_half_written_append(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_s.csv", csv_text(F1_ROWS))
    whole, store = Store(os.path.join(workdir, "whole")), Store(os.path.join(workdir, "store"))
    loading.run_load(spark, land, whole, load_id="L1")
    # The crash: two of the load's rows were stored, nothing after them.
    from measures.sinks import tables
    tables.append_facts(store.begin(spark), whole.measurements(spark).orderBy("id").limit(2))
    assert loading.run_load(spark, land, store, load_id="L1").status() == {F1_JOB: "completed"}
    assert sums(spark, store) == (12, 12)
    assert sorted(r.id for r in store.measurements(spark).select("id").collect()) == sorted(
        r.id for r in whole.measurements(spark).select("id").collect())


@pytest.mark.parametrize("name", ["a[1].csv", "b{x,y}.csv", "c*.csv", "d?.csv"])
def test_glob_characters_in_a_file_name(spark, workdir, name):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_{name}", csv_text(F1_ROWS))
    write_file(land, f"{F2_JOB}_good.csv", csv_text(F2_ROWS))
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store)
    assert report.status() == {F1_JOB: "completed", F2_JOB: "completed"}
    assert store.measurements(spark).count() == 21


def test_very_long_quoted_field_fails_only_its_file(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_s.csv", csv_text('STUDY001,P001,"' + "x" * 100_000 + '"'))
    write_file(land, f"{F2_JOB}_good.csv", csv_text(F2_ROWS))
    report = loading.run_load(spark, land, Store(os.path.join(workdir, "store")))
    assert report.status() == {F1_JOB: "failed", F2_JOB: "completed"}


def test_job_folder_with_one_incomplete_header(spark, workdir):
    land = os.path.join(workdir, "landing", f"{F1_JOB}_s.csv")
    write_file(land, "part-0.csv", csv_text(F1_ROWS))
    short = "\n".join(",".join(r.split(",")[:4] + r.split(",")[5:7]) for r in F2_ROWS.splitlines())
    write_file(land, "part-1.csv",
               "study_id,participant_id,measurement_type,value,timestamp,site_id\n" + short + "\n")
    report = loading.run_load(spark, os.path.join(workdir, "landing"),
                              Store(os.path.join(workdir, "store")))
    assert report.status() == {F1_JOB: "failed"}
    assert report.jobs.collect()[0]["message"] == "Missing column unit; Missing column quality_score"


def test_header_matches_fixture_header():
    assert HEADER.split(",")[0] == "study_id"


def test_crlf_and_bom(spark, workdir):
    text = "﻿" + csv_text(F2_ROWS).replace("\n", "\r\n")
    land = os.path.join(workdir, "landing")
    os.makedirs(land, exist_ok=True)
    with open(os.path.join(land, f"{JOB}_crlf.csv"), "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store)
    assert report.status()[JOB] == "completed", report.jobs.collect()
    rows = {(r.participant_id, r.measurement_type): r for r in store.measurements(spark).collect()}
    r = rows[("P001", "heart_rate")]
    assert (r.value, r.site_id, str(r.quality_score)) == ("66", "SITE_B", "0.97")
    assert r.id == id_of("STUDY002|P001|2024-01-16 09:00:00+00:00|heart_rate|66")


def test_file_supplied_ids(spark, workdir):
    header = "id,study_id,participant_id,measurement_type,value,unit,timestamp,site_id,quality_score"
    good = ("{0F8FAD5B-D9CB-469F-A165-70867728950E},STUDY009,P001,glucose,95.5,mg/dL,"
            "2024-01-15T09:30:00Z,SITE_A,0.98")
    report, store = run_single(spark, workdir, f"{JOB}_ids.csv", header + "\n" + good + "\n")
    assert report.status()[JOB] == "completed"
    assert store.measurements(spark).first().id == "0f8fad5b-d9cb-469f-a165-70867728950e"


def test_file_supplied_bad_id_rejects(spark, workdir):
    header = "id,study_id,participant_id,measurement_type,value,unit,timestamp,site_id,quality_score"
    bad = "not-a-uuid,STUDY009,P001,glucose,95.5,mg/dL,2024-01-15T09:30:00Z,SITE_A,0.98"
    report, _ = run_single(spark, workdir, f"{JOB}_ids.csv", header + "\n" + bad + "\n")
    job = next(j for j in report.jobs.collect() if j["job_id"] == JOB)
    assert job["status"] == "failed" and 'column "id"' in job["message"]


def test_failed_job_history(spark, workdir):
    rows = "STUDY001,P001,pulse,72,bpm,2024-01-15T09:30:00Z,SITE_A,0.9\n" + F1_ROWS
    report, store = run_single(spark, workdir, f"{JOB}_case.csv", csv_text(rows))
    hist = [(r.status, r.progress) for r in store.jobs(spark).orderBy("event_at", "seq").collect()
            if r.job_id == JOB]
    assert hist == [("pending", 0), ("running", 0), ("running", 10), ("running", 30),
                    ("failed", 30)]
    job = ledger.job_by_id(store.jobs(spark), JOB).first()
    assert job.error_message == "Invalid types: ['pulse']"


def test_varchar_limit_rejects(spark, workdir):
    long_site = "S" * 51
    rows = f"STUDY001,P001,glucose,95.5,mg/dL,2024-01-15T09:30:00Z,{long_site},0.98\n" + F1_ROWS
    report, _ = run_single(spark, workdir, f"{JOB}_long.csv", csv_text(rows))
    job = next(j for j in report.jobs.collect() if j["job_id"] == JOB)
    assert job["status"] == "failed" and 'value too long for column "site_id"' in job["message"]


def test_empty_and_header_only_files(spark, workdir):
    land = os.path.join(workdir, "landing")
    empty_job = "eeeeeeee-0000-0000-0000-000000000001"
    head_job = "eeeeeeee-0000-0000-0000-000000000002"
    os.makedirs(land, exist_ok=True)
    open(os.path.join(land, f"{empty_job}_empty.csv"), "w").close()
    write_file(land, f"{head_job}_head.csv", HEADER)
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store)
    by_id = {j["job_id"]: j for j in report.jobs.collect()}
    assert by_id[empty_job]["status"] == "failed"
    assert by_id[empty_job]["message"].startswith("Extraction error")
    assert by_id[head_job]["status"] == "completed" and by_id[head_job]["rows"] == 0


def test_json_rows(spark, loaded):
    from measures.functions import to_json_lines
    spark, store, _, _ = loaded
    doc = to_json_lines(reads.query_measurements(
        store.measurements(spark), study_id="STUDY001", participant_id="P001",
        measurement_type="glucose")).first()[0]
    assert doc.startswith('{"id":"b5040dff-6f05-38d5-08ee-83a83cc26a9d","studyId":"STUDY001"')
    assert '"timestamp":"2024-01-15T09:30:00.000Z"' in doc and '"qualityScore":"0.98"' in doc


def test_missing_landing_folder(spark, workdir):
    manifest = [{"job_id": JOB, "filename": f"{JOB}_x.csv", "created_at": dt.datetime(2024, 1, 1)}]
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, os.path.join(workdir, "no-such-folder"), store,
                               manifest=manifest)
    assert report.status() == {JOB: "failed"}
    assert report.jobs.collect()[0]["message"] == f"File not found: {JOB}_x.csv"
    assert store.read(spark, "measurements") is None


def test_missing_column_and_invalid_type_reported_together(spark, workdir):
    header = "study_id,participant_id,measurement_type,value,timestamp,site_id,quality_score"
    body = ("STUDY001,P001,pulse,72,2024-01-15T09:30:00Z,SITE_A,0.9\n"
            "STUDY001,P001,glucose,95.5,2024-01-15T09:30:00Z,SITE_A,0.9")
    report, _ = run_single(spark, workdir, f"{JOB}_nounit.csv", header + "\n" + body + "\n")
    job = next(j for j in report.jobs.collect() if j["job_id"] == JOB)
    assert job["message"] == "Missing column unit; Invalid types: ['pulse']"


def test_file_without_uuid_or_with_spaces(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, "plain name study001.csv", csv_text(F1_ROWS))
    write_file(land, f"{JOB}_with space.csv", csv_text(F2_ROWS))
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store)
    assert sorted((j["filename"], j["status"], j["rows"]) for j in report.jobs.collect()) == [
        (f"{JOB}_with space.csv", "completed", 9), ("plain name study001.csv", "completed", 12)]
    assert store.measurements(spark).count() == 21


def test_percent_sign_in_file_name(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{JOB}_100%20done.csv", csv_text(F2_ROWS))
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store)
    assert [(j["filename"], j["status"], j["rows"]) for j in report.jobs.collect()] == [
        (f"{JOB}_100%20done.csv", "completed", 9)]


def test_same_job_in_a_later_load_counts_once(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_s.csv", csv_text(F1_ROWS))
    store = Store(os.path.join(workdir, "store"))
    loading.run_load(spark, land, store, load_id="L1")
    again = loading.run_load(spark, land, store, load_id="L2")
    assert again.status() == {F1_JOB: "completed"}
    assert store.measurements(spark).count() == 12
    assert store.rollup(spark).agg(F.sum("measurement_count")).first()[0] == 12


@pytest.mark.parametrize("rule", ["faithful", "exact"])
def test_rollup_rules_over_two_loads(spark, workdir, rule):
    from measures.operators import rollup as R
    a = "aaaaaaaa-1111-0000-0000-000000000001"
    b = "bbbbbbbb-1111-0000-0000-000000000002"
    first = ("STUDY001,P001,glucose,invalid,mg/dL,2024-01-15T09:00:00Z,SITE_A,\n"
             "STUDY001,P001,blood_pressure,120/80,mmHg,2024-01-15T09:00:00Z,SITE_A,0.9")
    second = ("STUDY001,P001,glucose,95.5,mg/dL,2024-01-15T10:00:00Z,SITE_A,0.9\n"
              "STUDY001,P001,blood_pressure,130/90,mmHg,2024-01-15T10:00:00Z,SITE_A,0.99")
    store = Store(os.path.join(workdir, "store"))
    write_file(os.path.join(workdir, "l1"), f"{a}_1.csv", csv_text(first))
    write_file(os.path.join(workdir, "l2"), f"{b}_2.csv", csv_text(second))
    loading.run_load(spark, os.path.join(workdir, "l1"), store, load_id="L1", rollup_rule=rule)
    loading.run_load(spark, os.path.join(workdir, "l2"), store, load_id="L2", rollup_rule=rule)
    if rule == "exact":  # a replay of the second load changes nothing
        loading.run_load(spark, os.path.join(workdir, "l2"), store, load_id="L2",
                         rollup_rule=rule)
    got = {r.measurement_type: r for r in store.rollup(spark).collect()}
    want = {r.measurement_type: r for r in R.daily_rollup(store.measurements(spark)).collect()}
    assert got["glucose"].measurement_count == 2
    if rule == "faithful":
        assert got["glucose"].avg_value is None            # NULL old average poisons the merge
        assert got["glucose"].avg_quality_score is None
        assert got["blood_pressure"].avg_systolic == 125.0
    else:
        for t in ("glucose", "blood_pressure"):
            for m in R.MEASURES:
                g, w = getattr(got[t], m), getattr(want[t], m)
                assert (g is None and w is None) or abs(g - w) < 1e-9, (t, m, g, w)
        assert got["glucose"].avg_value == 95.5


def test_spark_text_header_reader(spark, workdir):
    from measures.sources import landing
    land = os.path.join(workdir, "landing")
    header = "Quality_Score, Site ID ,timestamp,UNIT,value,Measurement Type,participant_id,study_id"
    body = "\n".join(",".join([r.split(",")[i] for i in (7, 6, 5, 4, 3, 2, 1, 0)])
                     for r in F2_ROWS.splitlines())
    write_file(land, f"{JOB}_reordered.csv", header + "\n" + body + "\n")
    write_file(land, f"{F1_JOB}_plain.csv", csv_text(F1_ROWS))
    auto = landing.scan(spark, land)
    jvm = landing.scan(spark, land, header_reader="jvm")
    key = lambda d: sorted(tuple(r) for r in d.drop("path").collect())
    assert key(auto.rows) == key(jvm.rows)
    assert sorted(r.header for r in jvm.files.collect()) == sorted(
        r.header for r in auto.files.collect())


def test_quoted_line_break_needs_multiline(spark, workdir):
    rows = ('STUDY001,P001,glucose,95.5,"mg/\ndL",2024-01-15T09:30:00Z,SITE_A,0.98\n'
            "STUDY001,P002,glucose,102.1,mg/dL,2024-01-15T10:15:00Z,SITE_A,0.97")
    land = os.path.join(workdir, "landing")
    write_file(land, f"{JOB}_ml.csv", csv_text(rows))
    store = Store(os.path.join(workdir, "store"))
    report = loading.run_load(spark, land, store, multiline=True)
    assert report.status()[JOB] == "completed"
    units = sorted(r.unit for r in store.measurements(spark).collect())
    assert units == ["mg/\ndL", "mg/dL"]


@pytest.mark.parametrize("rule", ["exact", "faithful"])
def test_rollup_heals_after_crash_before_rollup_commit(spark, workdir, monkeypatch, rule):
    from measures.operators import rollup as R
    from measures.sinks import tables
    store = Store(os.path.join(workdir, "store"))
    write_file(os.path.join(workdir, "l1"), f"{F1_JOB}_1.csv", csv_text(F1_ROWS))
    write_file(os.path.join(workdir, "l2"), f"{F2_JOB}_2.csv", csv_text(F2_ROWS))
    loading.run_load(spark, os.path.join(workdir, "l1"), store, load_id="L1", rollup_rule=rule)
    real = tables._rewrite_partitions

    def crash_on_rollup(commit, table, merged):
        if table == "rollup":
            raise RuntimeError("driver lost")
        return real(commit, table, merged)
    monkeypatch.setattr(tables, "_rewrite_partitions", crash_on_rollup)
    with pytest.raises(RuntimeError):
        loading.run_load(spark, os.path.join(workdir, "l2"), store, load_id="L2",
                         rollup_rule=rule)
    monkeypatch.setattr(tables, "_rewrite_partitions", real)
    loading.run_load(spark, os.path.join(workdir, "l2"), store, load_id="L2", rollup_rule=rule)
    got = sorted(tuple(r) for r in store.rollup(spark).select(*R.MEASURES[:1], "agg_day",
                                                                "participant_id",
                                                                "measurement_type").collect())
    want = sorted(tuple(r) for r in R.daily_rollup(store.measurements(spark))
                  .select(*R.MEASURES[:1], "agg_day", "participant_id", "measurement_type")
                  .collect())
    assert got == want and store.measurements(spark).count() == 21
