"""Job ledger as an append-only event table.

Each state change is a row (job_id, status, progress, message, event_at,
seq); the current state of a job is its latest event.  No row is updated in
place, so concurrent readers never see a half-written job, and the history
stays available.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.functions.serialize import iso_z
from measures.schema import (LEDGER_SCHEMA, MSG_LOADED, MSG_STARTED, MSG_TRANSFORMED,
                             MSG_VALIDATED, PROGRESS)

EVENT_FIELDS = [f.name for f in LEDGER_SCHEMA.fields]


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def pending_events(jobs: DataFrame, at: dt.datetime | None = None,
                   load_id: str | None = None) -> DataFrame:
    """L1: record submitted jobs (job_id, filename, study_id) as pending."""
    return _events(jobs, F.array(_event("pending", 0, None, 0)), at or now(), load_id)


# Stages a job passes, in order: (stage, progress).
STAGES = (("extract", PROGRESS["extracted"]), ("transform", PROGRESS["transformed"]),
          ("validate", PROGRESS["validated"]), ("load", PROGRESS["loaded"]))


def stage_events(jobs: DataFrame, phase: str, at: dt.datetime, load_id: str) -> DataFrame:
    """L2/L3: a job's history as events, written in two phases.

    phase "checked" (before any table changes): `running`, then one event per
    stage the job passed checks for (extract 10 %, transform 30 %,
    validate 50 %).  phase "finished": `Loaded into DB` (90 %) for loaded
    jobs, then the final state -- completed (100 %) or failed with the
    progress of its last passed stage and the error message.

    `jobs`: job_id, filename, study_id, status, progress, message, rows and
    failed_stage (null when the job passed every check).
    """
    passed = F.coalesce(
        *[F.when(F.col("failed_stage") == s, F.lit(i)) for i, (s, _) in enumerate(STAGES)],
        F.when(F.col("status") == "completed", F.lit(len(STAGES))).otherwise(len(STAGES) - 1))
    texts = (F.concat(F.lit("Extracted "), F.col("rows").cast("string"), F.lit(" rows")),
             F.lit(MSG_TRANSFORMED), F.lit(MSG_VALIDATED), F.lit(MSG_LOADED))
    stage = [F.when(passed > i, _event("running", STAGES[i][1], texts[i], 2 + i))
             for i in range(len(STAGES))]
    if phase == "checked":
        events = F.array(_event("running", PROGRESS["started"], F.lit(MSG_STARTED), 1), *stage[:3])
    else:
        final = F.struct(
            F.col("status").alias("status"), F.col("progress").cast("int").alias("progress"),
            F.col("message").alias("message"),
            F.when(F.col("status") == "failed", F.col("message")).alias("error_message"),
            F.lit(6).alias("seq"))
        events = F.array(stage[3], final)
    return _events(jobs, events, at, load_id)


def _event(status: str, progress: int, message, seq: int):
    return F.struct(F.lit(status).alias("status"), F.lit(progress).alias("progress"),
                    (F.lit(None) if message is None else message).cast("string").alias("message"),
                    F.lit(None).cast("string").alias("error_message"), F.lit(seq).alias("seq"))


def _events(jobs: DataFrame, events, at: dt.datetime, load_id: str | None) -> DataFrame:
    rows = jobs.select("job_id", "filename", "study_id", F.explode(
        F.filter(events, lambda e: e.isNotNull())).alias("e"))
    return rows.select(
        "job_id", "filename", "study_id",
        *[f"e.{c}" for c in ("status", "progress", "message", "error_message")],
        F.lit(at).cast("timestamp_ntz").alias("event_at"), "e.seq",
        F.lit(load_id).cast("string").alias("load_id"))


def current_jobs(events: DataFrame) -> DataFrame:
    """L4 for all jobs: one row per job with the 8 fields of a job lookup
    plus progress and message (the latest event wins; ties by seq)."""
    order = F.struct("event_at", "seq")
    return events.groupBy("job_id").agg(
        F.max_by("filename", F.when(F.col("filename").isNotNull(), order)).alias("filename"),
        F.max_by("study_id", F.when(F.col("study_id").isNotNull(), order)).alias("study_id"),
        F.max_by("status", order).alias("status"),
        F.max_by("progress", order).alias("progress"),
        F.max_by("message", order).alias("message"),
        F.min("event_at").alias("created_at"),
        F.max("event_at").alias("updated_at"),
        F.max(F.when(F.col("status") == "completed", F.col("event_at"))).alias("completed_at"),
        F.max_by("error_message", F.when(F.col("error_message").isNotNull(), order))
        .alias("error_message"))


def job_by_id(events: DataFrame, job_id: str, api_layout: bool = False) -> DataFrame:
    """One job's record (empty result = not found).  The filter is
    applied before the aggregation, so only that job's events are read.
    `api_layout` renders it as a service would: camelCase fields and ISO-8601
    UTC timestamps with milliseconds."""
    job = current_jobs(events.where(F.col("job_id") == job_id)).select(
        F.col("job_id").alias("id"), "filename", "study_id", "status", "created_at",
        "updated_at", "completed_at", "error_message")
    if not api_layout:
        return job
    return job.select(
        "id", "filename", F.col("study_id").alias("studyId"), "status",
        *[iso_z(c).alias(a) for c, a in (("created_at", "createdAt"), ("updated_at", "updatedAt"),
                                         ("completed_at", "completedAt"))],
        F.col("error_message").alias("errorMessage"))


def job_status(stored: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """Status, progress and message per job.  A live view (e.g.
    the verdicts of a load still running) overrides the stored state; without
    one, the stored state is reported."""
    base = current_jobs(stored).select("job_id", "status", "progress", "message")
    if live is None:
        return base
    lv = live.select("job_id", F.col("status").alias("live_status"),
                     F.col("progress").alias("live_progress"),
                     F.col("message").alias("live_message"))
    j = base.join(lv, "job_id", "left")
    return j.select("job_id", F.coalesce("live_status", "status").alias("status"),
                    F.coalesce("live_progress", "progress").alias("progress"),
                    F.coalesce("live_message", "message").alias("message"))
