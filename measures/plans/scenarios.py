"""Loads, streams and deletions with content, derived from `events`, and the SQL
that judges the same rows anew.

* `etl_retry_*`: a load that crashes before several of its steps, and is sent
  again under a new load id each time, equals one clean load.
* `chain_*`: files of one batch that share rows with the file before them; the
  first accepted of two neighbours wins (V6).
* `stream_jobs`, `stream_job_facts`: jobs of two files each, some spoilt in the
  second file, ingested a few files at a time, and a job whose file is empty.
* `stream_rollup_late`: three loads that all hold rows of every day.
* `cascade_*`: one study, a fifth of the participants and one site are deleted
  from a store (V8); `fk_orphans_planted`: rows whose parents are missing (V7).
* `etl_job_record`: all fields of a completed and of a failed job (L4).
* `q1_positions`, `q5_positions`: the place of every row in Q1's and Q5's order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.functions.ids import uuid_layout
from measures.operators import constraints, ledger
from measures.operators.ordering import with_position
from measures.plans import analytics, loading
from measures.plans.dirty import _UUID, FACTS, _clean, _once, _rollup_of, _text_rows
from measures.plans.params import RECENT_AS_OF, RECENT_DAYS
from measures.sinks import tables
from measures.sinks.landing import JOB_DIR
from measures.sources.store import Store
from measures.streaming import start_ingest
from measures.streaming.rollup import start_rollup_stream

INSTANT = dt.datetime(2024, 3, 1, 12)
CRASHES = ("enrollments", "rollup", "publish")
CHAIN_DAYS = 5  # days of a chain's file
GONE_STUDY, GONE_SITE = "STUDY002", "SITE_B"
RECORDED = ("STUDY001", "2024-01-05")  # study and first day of the failed job looked up


class Crash(Exception):
    pass


def crash_at(step: str):
    def on_step(now: str) -> None:
        if now == step:
            raise Crash(step)
    return on_step


def retried_store(spark: SparkSession, sf_dir: str) -> Store:
    def build(base: str) -> Store:
        _clean(_text_rows(spark, sf_dir, "first"), f"{base}/landing")
        store = Store(f"{base}/store")
        for step in CRASHES:
            try:
                loading.run_load(spark, f"{base}/landing", store, rollup_rule="exact",
                                 on_step=crash_at(step))
            except Crash:
                pass
        loading.run_load(spark, f"{base}/landing", store, rollup_rule="exact")
        return store
    return _once(spark, sf_dir, "retried", build)


def _chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each study's 5-day files; every 10th also in the file after."""
    rows = _text_rows(spark, sf_dir, "chain")
    first = F.floor(F.datediff("ts", F.lit(dt.date(2000, 1, 1))) / CHAIN_DAYS)
    part = F.explode(F.when(F.col("event_id") % 10 == 0, F.array(first, first + 1)).otherwise(
        F.array(first)))
    rows = rows.withColumn("part", part)
    name = F.concat_ws("_", F.lit("chain"), "study_id", F.col("part").cast("string"))
    return rows.withColumn(JOB_DIR, F.concat(uuid_layout(F.md5(name)), F.lit("_"), name))


def chained_store(spark: SparkSession, sf_dir: str) -> Store:
    def build(base: str) -> Store:
        rows, store = _chained(spark, sf_dir), Store(f"{base}/store")
        _clean(rows, f"{base}/landing")
        manifest = rows.select(
            F.substring(JOB_DIR, 1, 36).alias("job_id"), F.col(JOB_DIR).alias("filename"),
            "study_id", F.expr("timestamp_ntz'2000-01-01' + make_interval(0, 0, 0, part)")
            .alias("created_at")).distinct()
        loading.run_load(spark, f"{base}/landing", store, manifest=manifest, rollup_rule="exact")
        return store
    return _once(spark, sf_dir, "chained", build)


def streamed_store(spark: SparkSession, sf_dir: str) -> Store:
    """Each study is a job of two files (of more where they are large); those of
    studies whose number is even name an unknown type in their second file."""
    def build(base: str) -> Store:
        rows = _text_rows(spark, sf_dir, "stream")
        name = F.concat(F.lit("stream_"), F.col("study_id"))
        rows = rows.withColumn(JOB_DIR, F.concat(uuid_layout(F.md5(name)), F.lit("_"), name))
        second = F.col("event_id") % 2 == 1
        spoilt = second & (F.substring("study_id", -1, 1).cast("int") % 2 == 0) & (
            F.col("event_id") % 7 == 0)
        rows = rows.withColumn("measurement_type", F.when(spoilt, "pulse").otherwise(
            F.col("measurement_type")))
        jobs = rows.select(JOB_DIR).distinct().count()
        _clean(rows.where(~second), f"{base}/landing")
        _clean(rows.where(second), f"{base}/landing")
        empty = spark.createDataFrame([], "line string").coalesce(1)
        empty.write.text(f"{base}/landing/{JOB_DIR}={EMPTY_JOB}_empty")
        store = Store(f"{base}/store")
        # An odd number of files: a cut by files would split a job.
        start_ingest(spark, f"{base}/landing", store, f"{base}/checkpoint", glob="part-*",
                     max_files_per_trigger=2 * (jobs // 2) + 1).awaitTermination()
        return store
    return _once(spark, sf_dir, "streamed", build)


EMPTY_JOB = "eeeeeeee-0000-0000-0000-00000000000e"


def late_rollup_store(spark: SparkSession, sf_dir: str) -> Store:
    def build(base: str) -> Store:
        rows = _text_rows(spark, sf_dir, "late")
        source, target = Store(f"{base}/facts"), Store(f"{base}/rollup")
        for i in range(3):
            part = F.concat(F.lit(f"late{i}_"), F.col("study_id"))
            _clean(rows.where(F.col("event_id") % 3 == i).withColumn(
                JOB_DIR, F.concat(uuid_layout(F.md5(part)), F.lit("_"), part)), f"{base}/l{i}")
            loading.run_load(spark, f"{base}/l{i}", source)
            start_rollup_stream(spark, source, target, f"{base}/checkpoint").awaitTermination()
        return target
    return _once(spark, sf_dir, "late", build)


def _with_jobs(spark: SparkSession, sf_dir: str, base: str, label: str) -> Store:
    """One load of one job per study, submitted with its study; jobs of even
    studies' last digit stay whole, others too: all complete."""
    rows = _text_rows(spark, sf_dir, label)
    name = F.concat(F.lit(f"{label}_"), F.col("study_id"))
    rows = rows.withColumn(JOB_DIR, F.concat(uuid_layout(F.md5(name)), F.lit("_"), name))
    _clean(rows, f"{base}/landing")
    store = Store(f"{base}/store")
    manifest = rows.select(F.substring(JOB_DIR, 1, 36).alias("job_id"),
                           F.col(JOB_DIR).alias("filename"), "study_id").distinct()
    missing = spark.createDataFrame([(MISSING, "gone.csv", GONE_STUDY)],
                                    "job_id string, filename string, study_id string")
    loading.run_load(spark, f"{base}/landing", store, manifest=manifest.union(missing),
                     instant=INSTANT, load_id=label)
    return store


MISSING = "dddddddd-0000-0000-0000-000000000002"


def recorded_store(spark: SparkSession, sf_dir: str) -> Store:
    return _once(spark, sf_dir, "recorded", lambda base: _with_jobs(spark, sf_dir, base, "rec"))


def cascaded_store(spark: SparkSession, sf_dir: str) -> Store:
    def build(base: str) -> Store:
        store = _with_jobs(spark, sf_dir, base, "rec")
        people = store.read(spark, "participants").where(
            "CAST(substr(participant_id, -1) AS INT) % 5 = 0")
        tables.delete_keys(spark, store, participants=people,
                           studies=spark.createDataFrame([(GONE_STUDY,)], "k string"),
                           sites=spark.createDataFrame([(GONE_SITE,)], "k string"))
        return store
    return _once(spark, sf_dir, "cascaded", build)


def q_chain_verdicts(spark, d):
    return ledger.current_jobs(chained_store(spark, d).jobs(spark)).select(
        "job_id", "study_id", "status", "progress", "message")


def q_stream_jobs(spark, d):
    return ledger.current_jobs(streamed_store(spark, d).jobs(spark)).select(
        "job_id", "status", "progress", "message")


def q_fk_orphans_planted(spark, d):
    s = recorded_store(spark, d)
    few = "CAST(substr(participant_id, -1) AS INT) % 5 <> 0"
    return constraints.fk_orphans(
        s.measurements(spark), s.read(spark, "studies").where(f"study_id <> '{GONE_STUDY}'"),
        s.read(spark, "sites").where(f"site_id <> '{GONE_SITE}'"),
        s.read(spark, "participants").where(few), s.enrollments(spark).where(
            f"{few} OR study_id = '{GONE_STUDY}'"))


def q_etl_job_record(spark, d):
    return ledger.current_jobs(recorded_store(spark, d).jobs(spark)).select(
        F.col("job_id").alias("id"), "filename", "study_id", "status", "created_at",
        "updated_at", "completed_at", "error_message")


def q_q1_positions(spark, d):
    rows = analytics.quality_by_study(recorded_store(spark, d).measurements(spark))
    return with_position(rows, F.desc("avg_qs"), F.asc("study_id"))


def q_q5_positions(spark, d):
    rows = analytics.recent_measurements(recorded_store(spark, d).measurements(spark),
                                         RECENT_DAYS, RECENT_AS_OF)
    return with_position(rows.select("id", "timestamp", "processed_at"), F.asc("timestamp"),
                         F.asc("id"))


QUERIES = {
    "etl_retry_facts": lambda spark, d: retried_store(spark, d).measurements(spark).select(*FACTS),
    "etl_retry_rollup": lambda spark, d: _rollup_of(retried_store(spark, d), spark),
    "chain_verdicts": q_chain_verdicts,
    "chain_facts": lambda spark, d: chained_store(spark, d).measurements(spark).select(*FACTS),
    "stream_jobs": q_stream_jobs,
    "stream_job_facts": lambda spark, d: streamed_store(spark, d).measurements(spark).select(
        *FACTS),
    "stream_rollup_late": lambda spark, d: _rollup_of(late_rollup_store(spark, d), spark),
    "cascade_facts": lambda spark, d: cascaded_store(spark, d).measurements(spark).select(*FACTS),
    "cascade_enrollments": lambda spark, d: cascaded_store(spark, d).enrollments(spark).select(
        "participant_id", "study_id", "enrolled_at"),
    "cascade_jobs": lambda spark, d: ledger.current_jobs(
        cascaded_store(spark, d).jobs(spark)).select("job_id", "study_id", "status"),
    "fk_orphans_planted": q_fk_orphans_planted,
    "etl_job_record": q_etl_job_record,
    "q1_positions": q_q1_positions,
    "q5_positions": q_q5_positions,
}

# --- SQL twins -----------------------------------------------------------------
_AT = f"TIMESTAMP '{INSTANT}'"
_DONE = "'completed' AS status, 100 AS progress, 'Job completed successfully' AS message"
_DUP = ("Load error: duplicate key value violates unique constraint "
        "(id loaded by an earlier job)")
_EMPTY = "Extraction error: No columns to parse from file"
_FEW = "CAST(right(participant_id, 1) AS INTEGER) % 5"


def _job(name: str) -> str:
    return _UUID.format(x=name)


_CHAIN = """
parts AS (
  SELECT *, floor(date_diff('day', DATE '2000-01-01', CAST("timestamp" AS DATE)) / 5.0)::BIGINT
            AS part FROM facts),
links AS (
  SELECT study_id, part + 1 AS part, count(*) AS n FROM parts
  WHERE event_id % 10 = 0 GROUP BY ALL),
files AS (
  SELECT study_id, part FROM parts UNION SELECT study_id, part FROM links),
runs AS (  -- a file starts a chain unless it shares rows with the file before
  SELECT *, sum(CASE WHEN tied THEN 0 ELSE 1 END) OVER (PARTITION BY study_id ORDER BY part) AS chain
  FROM (SELECT f.study_id, f.part, l.n IS NOT NULL AND b.part IS NOT NULL AS tied
        FROM files f LEFT JOIN links l USING (study_id, part)
        LEFT JOIN files b ON b.study_id = f.study_id AND b.part = f.part - 1)),
jobs AS (
  SELECT study_id, part, 'chain_' || study_id || '_' || part AS name,
         row_number() OVER (PARTITION BY study_id, chain ORDER BY part) % 2 = 1 AS accepted
  FROM runs)"""


def oracles(with_facts, fact_columns: str, rollup: str, q1: str) -> dict[str, str]:
    rec = _job("('rec_' || study_id)")
    record = with_facts() + f"""
SELECT DISTINCT {rec} AS id, {rec} || '_rec_' || study_id AS filename, study_id,
       'completed' AS status, {_AT} AS created_at, {_AT} AS updated_at, {_AT} AS completed_at,
       CAST(NULL AS VARCHAR) AS error_message FROM facts
UNION ALL SELECT '{MISSING}', 'gone.csv', '{GONE_STUDY}', 'failed', {_AT}, {_AT}, NULL,
       'File not found: gone.csv'"""
    even = "CAST(right(study_id, 1) AS INTEGER) % 2 = 0"
    bad = f"bool_or({even} AND event_id % 2 = 1 AND event_id % 7 = 0)"
    stream = _job("('stream_' || study_id)")
    return {
        "etl_retry_facts": with_facts() + f"SELECT {fact_columns}, "
        + _job("('first_' || study_id || '_' || CAST(CAST(\"timestamp\" AS DATE) AS VARCHAR))")
        + " AS job_id FROM facts",
        "etl_retry_rollup": rollup,
        "chain_verdicts": with_facts(_CHAIN) + f"""
SELECT {_job('name')} AS job_id, study_id,
       CASE WHEN accepted THEN 'completed' ELSE 'failed' END AS status,
       CASE WHEN accepted THEN 100 ELSE 50 END AS progress,
       CASE WHEN accepted THEN 'Job completed successfully' ELSE '{_DUP}' END AS message
FROM jobs""",
        "chain_facts": with_facts(_CHAIN) + f"""
SELECT {fact_columns}, {_job('name')} AS job_id
FROM (SELECT p.* EXCLUDE (part), j.name FROM parts p JOIN jobs j ON j.study_id = p.study_id
        AND (j.part = p.part OR p.event_id % 10 = 0 AND j.part = p.part + 1) WHERE accepted)""",
        "stream_jobs": with_facts() + f"""
SELECT {stream} AS job_id, CASE WHEN {bad} THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN {bad} THEN 30 ELSE 100 END AS progress,
       CASE WHEN {bad} THEN 'Invalid types: [''pulse'']' ELSE 'Job completed successfully' END
       AS message FROM facts GROUP BY study_id
UNION ALL SELECT '{EMPTY_JOB}', 'failed', 0, '{_EMPTY}'""",
        "stream_job_facts": with_facts() + f"""
SELECT {fact_columns}, {stream} AS job_id FROM facts WHERE study_id IN (
  SELECT study_id FROM facts GROUP BY study_id HAVING NOT {bad})""",
        "stream_rollup_late": rollup,
        "cascade_facts": with_facts() + f"SELECT {fact_columns}, {rec} AS job_id FROM facts "
        f"WHERE study_id <> '{GONE_STUDY}' AND site_id <> '{GONE_SITE}' AND {_FEW} <> 0",
        "cascade_enrollments": with_facts() + "SELECT participant_id, study_id, "
        f"MIN(\"timestamp\") AS enrolled_at FROM facts WHERE study_id <> '{GONE_STUDY}' "
        f"AND {_FEW} <> 0 GROUP BY ALL",
        "cascade_jobs": f"SELECT id AS job_id, CASE WHEN study_id <> '{GONE_STUDY}' THEN study_id "
        f"END AS study_id, status FROM ({record})",
        "fk_orphans_planted": with_facts(f"""
enrolled AS (SELECT DISTINCT participant_id, study_id FROM facts
             WHERE {_FEW} <> 0 OR study_id = '{GONE_STUDY}')""") + f"""
SELECT 'measurement.study_id -> studies' AS "constraint",
       COUNT(*) FILTER (study_id = '{GONE_STUDY}') AS orphan_rows FROM facts
UNION ALL SELECT 'measurement.site_id -> sites', COUNT(*) FILTER (site_id = '{GONE_SITE}') FROM facts
UNION ALL SELECT 'measurement.(participant_id, study_id) -> enrollments',
       COUNT(*) FILTER ({_FEW} = 0 AND study_id <> '{GONE_STUDY}') FROM facts
UNION ALL SELECT 'enrollment.participant_id -> participants',
       COUNT(*) FILTER ({_FEW} = 0) FROM enrolled
UNION ALL SELECT 'enrollment.study_id -> studies',
       COUNT(*) FILTER (study_id = '{GONE_STUDY}') FROM enrolled""",
        "etl_job_record": record,
        "q1_positions": f"SELECT *, row_number() OVER (ORDER BY avg_qs DESC, study_id) AS position "
        f"FROM ({q1})",
        "q5_positions": with_facts() + f"""
SELECT id, "timestamp", {_AT} AS processed_at,
       row_number() OVER (ORDER BY "timestamp", id) AS position FROM facts
WHERE "timestamp" >= CAST(DATE '{RECENT_AS_OF.isoformat()}' - INTERVAL {RECENT_DAYS} DAY AS TIMESTAMP)""",
    }
