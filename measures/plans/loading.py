"""The batch load: landing files -> typed rows -> per-file verdicts -> tables.

One call processes every file under a landing folder as one load (each file
is a job, accepted or rejected whole):

  scan (I1-I5) -> transform (S1-S7) -> verdicts (V1-V5) -> duplicate ids (V6)
  -> studies, participants, enrollments, sites (K2, K3) -> facts (K1)
  -> roll-up merge (K4) -> ledger (L2)

Rows stay distributed throughout, and so do jobs: file facts, verdicts,
rejections and ledger events are DataFrames joined on the job id.  The driver
sees only the studies and days a load touches.

Everything a load changes is published in one commit (K5), the jobs' final
states with it: a load that crashes anywhere leaves the store as it was, and
sending the files again, under any load id, is a clean load.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.functions.parsing import as_day
from measures.operators import constraints, dimensions, ledger, validate
from measures.schema import MSG_COMPLETED, PROGRESS, REQUIRED_COLUMNS, LOADED_COLUMNS
from measures.session import ensure_session
from measures.sinks import tables
from measures.sources import landing
from measures.sources.store import Store

MANIFEST = "job_id string, m_filename string, m_study_id string, m_created_at timestamp_ntz, " \
           "m_listed boolean"
FLAGS = ("_too_long", "_bp_overflow", "_has_id", "_bad_id")
# What a load writes, in order; `on_step` is told before each.
STEPS = ("ledger", "studies", "participants", "enrollments", "sites", "measurements", "rollup",
         "publish")


@dataclass
class LoadReport:
    load_id: str
    jobs: DataFrame           # job_id, filename, study_id, status, progress, message, rows
    accepted_rows: DataFrame  # typed rows of accepted jobs (lazy)

    def status(self) -> dict[str, str]:
        """For loads of few files: status by job id."""
        return {j["job_id"]: j["status"] for j in self.jobs.collect()}


def submit_jobs(spark: SparkSession, store: Store, jobs: list[dict]) -> None:
    """L1: record jobs as pending and make sure their studies exist."""
    rows = spark.createDataFrame(
        [(j["job_id"], j.get("filename"), j.get("study_id")) for j in jobs],
        "job_id string, filename string, study_id string")
    with tables.committing(spark, store) as commit:
        tables.append_keys(commit, "studies", "study_id", rows.where("study_id IS NOT NULL"))
        tables.append_ledger(commit, ledger.pending_events(rows))


def run_load(spark: SparkSession, landing_root: str | list[str], store: Store,
             manifest: list[dict] | DataFrame | None = None, load_id: str | None = None,
             instant: dt.datetime | None = None, glob: str = "*.csv",
             rollup_rule: str = "faithful", multiline: bool = False,
             on_step: Callable[[str], None] | None = None,
             also: Callable[[object], None] | None = None) -> LoadReport:
    """Load every file under `landing_root` into `store` as one load.

    `manifest`: optional submitted jobs (job_id, filename, study_id,
    created_at); a listed job without a file fails with `File not found`.
    `instant`: when the load takes place (processed_at, ledger events), else now.
    `load_id`: a name for the load, kept in the ledger and with the facts.
    `rollup_rule`: "faithful" merges into the roll-up with the reference's
    upsert rule (A5); "exact" keeps partial sums so the roll-up always equals
    a recompute (A6).  Use one rule for the life of a store.
    `multiline`: accept quoted fields with line breaks (each file is then
    read by one task).
    `on_step` is called with each of STEPS before it is taken; `also` gets the
    commit before it is published, to add to it.
    """
    ensure_session(spark)
    load_id = load_id or uuid.uuid4().hex
    started = instant or ledger.now()
    scan = landing.scan(spark, landing_root, glob, multiline=multiline)
    # Parsed once, to the shared scratch folder: later steps read the columns
    # they need, and a lost executor costs no parsing.
    typed = landing.written(validate.transform(scan.rows, started), "typed")
    return _load(spark, store, scan, typed, _manifest(spark, manifest), load_id, started,
                 rollup_rule, on_step or (lambda step: None), also,
                 (lambda: instant) if instant else ledger.now)


def _manifest(spark: SparkSession, manifest: list[dict] | DataFrame | None) -> DataFrame:
    if isinstance(manifest, DataFrame):
        have = manifest.columns
        return manifest.select("job_id", *[
            (F.col(c) if c in have else F.lit(None)).cast(t).alias(f"m_{c}") for c, t in
            (("filename", "string"), ("study_id", "string"), ("created_at", "timestamp_ntz"))],
            F.lit(True).alias("m_listed"))
    return spark.createDataFrame(
        [(m["job_id"], m.get("filename"), m.get("study_id"), m.get("created_at"), True)
         for m in manifest or []], MANIFEST)


def judged_jobs(files: DataFrame, typed: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per job, submitted or found: its file facts and row verdict
    folded into failed_stage, message and progress, in stage order -- file
    missing or empty, over-long rows (extract), missing columns (validate, with
    any invalid types), then the row checks.  failed_stage is null for jobs
    that pass; duplicate ids come later."""
    order = (*REQUIRED_COLUMNS, *[c for c in LOADED_COLUMNS if c not in REQUIRED_COLUMNS])
    # A job may hold several files; each must have every column.
    found = files.groupBy("job_id").agg(
        F.min("filename").alias("filename"), F.min("modified").alias("modified"),
        F.max("empty").alias("empty"),
        *[F.max(F.array_contains("missing", c)).alias(f"lacks_{c}") for c in order],
        F.lit(True).alias("present"))
    j = (manifest.join(found, "job_id", "full_outer")
         .join(validate.file_verdicts(typed).withColumnsRenamed(
             {"message": "v_message", "progress": "v_progress"}), "job_id", "left"))
    present = F.coalesce("present", F.lit(False))
    missing = F.filter(F.array(*[F.when(F.col(f"lacks_{c}"), F.lit(c)) for c in order]),
                       lambda c: c.isNotNull())
    filename = F.coalesce("m_filename", "filename")
    lacking = F.array_join(F.transform(missing, lambda c: F.concat(F.lit("Missing column "), c)),
                           "; ")
    types = F.when(F.size("bad_types") > 0, F.concat(
        F.lit("Invalid types: "), validate.python_list(F.col("bad_types"))))
    cases = (  # condition, stage, progress, message
        (~present, "extract", "started", F.concat(F.lit("File not found: "), filename)),
        (F.col("empty"), "extract", "started",
         F.lit("Extraction error: No columns to parse from file")),
        (F.col("stage") == "extract", None, None, F.col("v_message")),
        (F.size(missing) > 0, "validate", "transformed", F.concat_ws("; ", lacking, types)),
        (F.col("stage").isNotNull(), None, None, F.col("v_message")))

    def first(pick):
        return F.coalesce(*[F.when(case[0], pick(case)) for case in cases])

    return j.select(
        "job_id", filename.alias("filename"), F.col("m_study_id").alias("study_id"),
        F.coalesce("m_created_at", "modified").alias("submitted"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        first(lambda c: F.lit(c[1]) if c[1] else F.col("stage")).alias("failed_stage"),
        first(lambda c: F.lit(PROGRESS[c[2]]) if c[2] else F.col("v_progress")).alias("progress"),
        first(lambda c: c[3]).alias("message"),
        F.col("m_listed").isNotNull().alias("recorded"), "studies", "days", "min_ts", "max_ts")


def _load(spark: SparkSession, store: Store, scan: landing.LandingScan, typed: DataFrame,
          manifest: DataFrame, load_id: str, started: dt.datetime, rollup_rule: str,
          on_step: Callable[[str], None], also, clock: Callable[[], dt.datetime]) -> LoadReport:
    judged = landing.written(judged_jobs(scan.files, typed, manifest), "judged")
    passing = judged.where("failed_stage IS NULL AND rows > 0")
    # Studies and days of the batch: what the store's partitions are named by.
    windows = {r["study"]: (r["lo"], r["hi"]) for r in passing.select(
        F.explode("studies").alias("study"), "min_ts", "max_ts").groupBy("study").agg(
        F.min("min_ts").alias("lo"), F.max("max_ts").alias("hi")).toLocalIterator()}
    rank = F.struct(F.coalesce("submitted", F.lit(dt.datetime(1, 1, 1))).alias("at"), "job_id")
    candidates = typed.join(passing.select("job_id", rank.alias("rank")), "job_id").select(
        "job_id", "rank", "study_id", "id", constraints.content_hash().alias("content"))
    stored = store.read_partitions(spark, "measurements", list(windows)) if windows else None
    stored_ids = constraints.stored_ids_for(stored, windows) if stored is not None else None
    rejected, again = constraints.resolve_duplicates(candidates, stored_ids) if windows else (
        spark.createDataFrame([], constraints.REJECTIONS), False)
    late = F.col("late").isNotNull()
    failed = F.col("failed_stage").isNotNull() | late
    jobs = landing.written(
        judged.join(rejected.select("job_id", F.col("message").alias("late")), "job_id", "left")
        .select("job_id", "filename", "study_id",
                F.when(failed, "failed").otherwise("completed").alias("status"),
                F.when(late, PROGRESS["validated"]).when(failed, F.col("progress"))
                .otherwise(PROGRESS["completed"]).alias("progress"),
                F.when(late, F.col("late")).when(failed, F.col("message"))
                .otherwise(MSG_COMPLETED).alias("message"), "rows",
                F.when(late, "load").otherwise(F.col("failed_stage")).alias("failed_stage"),
                "recorded", "studies", "days"), "jobs")
    accepted = jobs.where("status = 'completed' AND rows > 0")
    rows = typed.join(accepted.select("job_id"), "job_id", "left_semi").drop(*FLAGS)
    # The ledger shows the load as running before any table changes; jobs
    # not submitted through a manifest are recorded as pending first.
    on_step("ledger")
    with tables.committing(spark, store) as commit:
        tables.append_ledger(commit, ledger.pending_events(
            jobs.where("NOT recorded"), started, load_id).unionByName(
            ledger.stage_events(jobs, "checked", clock(), load_id)))
    commit = store.begin(spark)
    days = [r[0] for r in accepted.select(F.explode("days")).distinct().toLocalIterator()]
    if days:
        # A job sent again: rows are taken one by one.  Facts and roll-up are
        # published together, so the rows not stored are those not counted.
        new = rows
        if again:
            # Written once: facts and roll-up both read it, and days without a
            # new row keep their roll-up.
            new = landing.written(rows.join(stored_ids.select(
                *constraints.KEY, F.col("stored_job_id").alias("job_id")),
                [*constraints.KEY, "job_id"], "left_anti"), "new")
            days = tables.touched_keys(new.select(as_day("timestamp").alias("day")), "day")
        studies = [r[0] for r in accepted.select(F.explode("studies")).distinct()
                   .toLocalIterator()]
        _write(commit, rows, new, load_id, studies, days, rollup_rule, on_step)
    tables.append_ledger(commit, ledger.stage_events(jobs, "finished", clock(), load_id))
    if also:
        also(commit)
    on_step("publish")
    commit.publish()
    return LoadReport(load_id=load_id, accepted_rows=rows, jobs=jobs.select(
        "job_id", "filename", "study_id", "status", "progress", "message", "rows"))


def _write(commit, rows: DataFrame, new: DataFrame, load_id: str, studies: list[str], days: list,
           rule: str, on_step: Callable[[str], None]) -> None:
    """K5 order: studies, participants, enrollments, sites, facts, roll-up."""
    # The keys of a load and when they were first seen, from one pass.
    keys = landing.written(rows.groupBy("study_id", "participant_id", "site_id").agg(
        F.min("timestamp").alias("timestamp")), "keys")
    for table, key in (("studies", "study_id"), ("participants", "participant_id")):
        on_step(table)
        tables.append_keys(commit, table, key, keys)
    on_step("enrollments")
    tables.merge_enrollments(commit, dimensions.first_seen(keys), studies)
    on_step("sites")
    tables.append_keys(commit, "sites", "site_id", keys)
    on_step("measurements")
    tables.append_facts(commit, new.withColumn("load_id", F.lit(load_id)))
    on_step("rollup")
    tables.merge_rollup(commit, new, load_id, days, rule)
