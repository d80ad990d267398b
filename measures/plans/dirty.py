"""Loads with content that must be rejected, derived from `events`, and loads
that are interrupted or repeated; their SQL twins judge the same rows anew.

Every (study, day) is one job; the day of the month decides what is wrong with
its file, and within it the rows whose event_id is a multiple of 7 carry it:

  day % 8   file
  0, 7      clean; 7 with odd header names and order, +02:00 offsets, white
            space around fields, and `0.9d` as quality in every 5th row
  1         a type that is not known       4   a site longer than its column
  2         an unreadable timestamp        5   two columns missing
  3         a missing value                6   the row is there twice

A second load repeats the day % 8 = 0 files under other job ids (their ids are
stored already) and names one file that does not exist.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.functions.ids import uuid_layout
from measures.operators import ledger
from measures.plans import loading
from measures.session import ensure_session, scratch_dir
from measures.sinks import tables
from measures.sinks.landing import ISO_MICROS_Z, JOB_DIR, LANDING_COLUMNS
from measures.sources import adapter
from measures.sources.store import Store

MISSING_JOB = "dddddddd-0000-0000-0000-000000000001"
_ODD_HEADER = {"quality_score": "Quality_Score", "site_id": "Site ID", "timestamp": "TIMESTAMP",
               "unit": "Unit", "value": "value", "measurement_type": "Measurement Type",
               "participant_id": "participant_id", "study_id": "Study_Id"}
_CACHE: dict[tuple, Store] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build) -> Store:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _CACHE:
        ensure_session(spark)
        _CACHE[key] = build(scratch_dir(spark, label))
    return _CACHE[key]


def _text_rows(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Landing text of every measurement, with its job folder."""
    m = adapter.measurements(adapter.read_events(spark, sf_dir))
    name = F.concat_ws("_", F.lit(prefix), "study_id", F.to_date("timestamp").cast("string"))
    return m.select(
        "event_id", F.col("timestamp").alias("ts"), F.dayofmonth("timestamp").alias("day"),
        *[F.col(c) for c in LANDING_COLUMNS if c not in ("timestamp", "quality_score")],
        F.date_format("timestamp", ISO_MICROS_Z).alias("timestamp"),
        F.col("quality_score").cast("string").alias("quality_score"),
        F.concat(uuid_layout(F.md5(name)), F.lit("_"), name).alias(JOB_DIR))


def _write(rows: DataFrame, columns: list[str], folder: str) -> None:
    (rows.select(*columns, JOB_DIR).hint("rebalance", JOB_DIR).write.mode("append")
     .option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).partitionBy(JOB_DIR).csv(folder))


def _stage(rows: DataFrame, folder: str) -> None:
    bad = F.col("event_id") % 7 == 0

    def spoilt(kind: int, column: str, text: str):
        return F.when((F.col("day") % 8 == kind) & bad, F.lit(text)).otherwise(F.col(column))

    plain = rows.where("day % 8 NOT IN (5, 7)").withColumns({
        "measurement_type": spoilt(1, "measurement_type", "pulse"),
        "timestamp": spoilt(2, "timestamp", "15/01/2024"), "value": spoilt(3, "value", "n/a"),
        "site_id": spoilt(4, "site_id", "S" * 60)})
    _write(plain.union(plain.where((F.col("day") % 8 == 6) & bad)), list(LANDING_COLUMNS), folder)
    _write(rows.where("day % 8 = 5"),
           [c for c in LANDING_COLUMNS if c not in ("unit", "quality_score")], folder)
    odd = rows.where("day % 8 = 7").withColumns({
        "timestamp": F.concat(F.date_format(F.expr("ts + interval 2 hours"),
                                            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")),
        "site_id": F.concat(F.lit("  "), "site_id", F.lit(" ")),
        "quality_score": F.when(F.col("event_id") % 5 == 0, F.lit("0.9d")).otherwise(
            F.col("quality_score"))})
    _write(odd.withColumnsRenamed(_ODD_HEADER), list(_ODD_HEADER.values()), folder)


def dirty_store(spark: SparkSession, sf_dir: str) -> Store:
    def build(base: str) -> Store:
        store = Store(f"{base}/store")
        _stage(_text_rows(spark, sf_dir, "first"), f"{base}/first")
        loading.run_load(spark, f"{base}/first", store, load_id="first")
        again = _text_rows(spark, sf_dir, "again").where("day % 8 = 0")
        _write(again, list(LANDING_COLUMNS), f"{base}/again")
        loading.run_load(spark, f"{base}/again", store, load_id="again", manifest=[
            {"job_id": MISSING_JOB, "filename": "gone.csv", "created_at": dt.datetime(2024, 1, 1)}])
        return store
    return _once(spark, sf_dir, "dirty", build)


FACTS = ("id", "study_id", "participant_id", "site_id", "measurement_type", "value", "unit",
         "timestamp", "quality_score", "value_num", "bp_systolic", "bp_diastolic", "job_id")


def q_dirty_verdicts(spark, d):
    return ledger.current_jobs(dirty_store(spark, d).jobs(spark)).select(
        "job_id", "filename", "status", "progress", F.coalesce("error_message", "message")
        .alias("message"))


def q_dirty_facts(spark, d):
    return dirty_store(spark, d).measurements(spark).select(*FACTS)


def q_dirty_history(spark, d):
    """Every event of the ledger: each stage each job reached."""
    return dirty_store(spark, d).jobs(spark).select("job_id", "status", "progress", "message")


def _clean(rows: DataFrame, folder: str) -> None:
    _write(rows, list(LANDING_COLUMNS), folder)


def resubmitted_store(spark: SparkSession, sf_dir: str) -> Store:
    """Every job is loaded without a third of its rows, then sent again whole,
    then once more."""
    def build(base: str) -> Store:
        rows, store = _text_rows(spark, sf_dir, "first"), Store(f"{base}/store")
        _clean(rows.where("event_id % 3 > 0"), f"{base}/part")
        _clean(rows, f"{base}/whole")
        for i, folder in enumerate(("part", "whole", "whole")):
            loading.run_load(spark, f"{base}/{folder}", store, load_id=f"r{i}",
                             rollup_rule="exact")
        return store
    return _once(spark, sf_dir, "resubmitted", build)


def replayed_store(spark: SparkSession, sf_dir: str) -> Store:
    """A load that crashed with a third of its facts written and nothing after
    them, replayed under its own load id, twice."""
    def build(base: str) -> Store:
        _clean(_text_rows(spark, sf_dir, "first"), f"{base}/landing")
        whole, store = Store(f"{base}/other"), Store(f"{base}/store")
        loading.run_load(spark, f"{base}/landing", whole, load_id="L", rollup_rule="exact")
        tables.append_facts(store.begin(spark),
                            whole.measurements(spark).where("pmod(hash(id), 3) = 0"))
        for _ in range(2):
            loading.run_load(spark, f"{base}/landing", store, load_id="L", rollup_rule="exact")
        return store
    return _once(spark, sf_dir, "replayed", build)


def q_etl_resubmit_facts(spark, d):
    return resubmitted_store(spark, d).measurements(spark).select(*FACTS)


def q_etl_replay_facts(spark, d):
    return replayed_store(spark, d).measurements(spark).select(*FACTS)


def _rollup_of(store: Store, spark) -> DataFrame:
    from measures.plans.catalog import round_doubles
    return round_doubles(store.rollup(spark).drop("load_id"))


def q_etl_resubmit_rollup(spark, d):
    return _rollup_of(resubmitted_store(spark, d), spark)


def q_etl_replay_rollup(spark, d):
    return _rollup_of(replayed_store(spark, d), spark)


QUERIES = {
    "dirty_verdicts": q_dirty_verdicts,
    "dirty_facts": q_dirty_facts,
    "dirty_history": q_dirty_history,
    "etl_resubmit_facts": q_etl_resubmit_facts,
    "etl_resubmit_rollup": q_etl_resubmit_rollup,
    "etl_replay_facts": q_etl_replay_facts,
    "etl_replay_rollup": q_etl_replay_rollup,
}

# --- SQL twins -----------------------------------------------------------------
_UUID = ("substr(md5({x}), 1, 8) || '-' || substr(md5({x}), 9, 4) || '-' || substr(md5({x}), 13, 4)"
         " || '-' || substr(md5({x}), 17, 4) || '-' || substr(md5({x}), 21, 12)")


def _job(prefix: str) -> str:
    return f"('{prefix}_' || study_id || '_' || CAST(CAST(\"timestamp\" AS DATE) AS VARCHAR))"


# One row per job: its kind, its rows, and whether a row carries the fault.
_JUDGED = f"""
judged AS (
  SELECT {_job('first')} AS name, day(any_value("timestamp")) % 8 AS kind,
         max(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) = 1 AS spoilt,
         count(*) AS own_rows,
         sum(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS spoilt_rows
  FROM facts GROUP BY 1),
verdicts AS (
  SELECT {_UUID.format(x='name')} AS job_id,
         {_UUID.format(x='name')} || '_' || name AS filename,
         own_rows + CASE WHEN kind = 6 THEN spoilt_rows ELSE 0 END AS n,
         CASE WHEN kind = 5 THEN 'validate'
              WHEN NOT spoilt OR kind IN (0, 7) THEN NULL
              WHEN kind = 1 THEN 'validate' WHEN kind = 2 THEN 'transform'
              ELSE 'load' END AS stage,
         CASE WHEN kind = 5 THEN 'Missing column unit; Missing column quality_score'
              WHEN NOT spoilt OR kind IN (0, 7) THEN 'Job completed successfully'
              WHEN kind = 1 THEN 'Invalid types: [''pulse'']'
              WHEN kind = 2 THEN 'Transform error: unreadable or missing timestamp'
              WHEN kind = 3 THEN 'Load error: null value in column "value" violates not-null constraint'
              WHEN kind = 4 THEN 'Load error: value too long for column "site_id"'
              ELSE 'Load error: duplicate key value violates unique constraint (id repeated in the file)'
         END AS message
  FROM judged
  UNION ALL
  SELECT {_UUID.format(x="replace(name, 'first', 'again')")},
         {_UUID.format(x="replace(name, 'first', 'again')")} || '_' || replace(name, 'first', 'again'),
         own_rows, 'load',
         'Load error: duplicate key value violates unique constraint (id already stored)'
  FROM judged WHERE kind = 0
  UNION ALL
  SELECT '{MISSING_JOB}', 'gone.csv', 0, 'extract', 'File not found: gone.csv')"""

_REACHED = "CASE stage WHEN 'extract' THEN 0 WHEN 'transform' THEN 10 WHEN 'validate' THEN 30 " \
           "WHEN 'load' THEN 50 ELSE 100 END"


def oracles(with_facts, fact_columns: str, rollup: str) -> dict[str, str]:
    facts = (f"SELECT {fact_columns}, {_UUID.format(x=_job('first'))} AS job_id FROM facts")
    return {
        "dirty_verdicts": with_facts(_JUDGED) + f"""
SELECT job_id, filename, CASE WHEN stage IS NULL THEN 'completed' ELSE 'failed' END AS status,
       {_REACHED} AS progress, message FROM verdicts""",
        "dirty_facts": with_facts(_JUDGED) + f"""
SELECT * EXCLUDE (event_id) REPLACE (
         CASE WHEN day("timestamp") % 8 = 7 AND event_id % 5 = 0 THEN NULL
              ELSE quality_score END AS quality_score)
FROM (SELECT {fact_columns}, event_id, {_UUID.format(x=_job('first'))} AS job_id FROM facts)
WHERE job_id IN (SELECT job_id FROM verdicts WHERE stage IS NULL)""",
        "dirty_history": with_facts(_JUDGED) + f"""

SELECT job_id, 'pending' AS status, 0 AS progress, CAST(NULL AS VARCHAR) AS message
FROM verdicts WHERE job_id <> '{MISSING_JOB}'
UNION ALL SELECT job_id, 'running', 0, 'Job started' FROM verdicts
UNION ALL SELECT job_id, 'running', 10, 'Extracted ' || n || ' rows' FROM verdicts
          WHERE stage IS DISTINCT FROM 'extract'
UNION ALL SELECT job_id, 'running', 30, 'Data transformed' FROM verdicts
          WHERE stage IS NULL OR stage IN ('validate', 'load')
UNION ALL SELECT job_id, 'running', 50, 'Validation passed' FROM verdicts
          WHERE stage IS NULL OR stage = 'load'
UNION ALL SELECT job_id, 'running', 90, 'Loaded into DB' FROM verdicts WHERE stage IS NULL
UNION ALL SELECT job_id, CASE WHEN stage IS NULL THEN 'completed' ELSE 'failed' END,
                 {_REACHED}, message FROM verdicts""",
        "etl_resubmit_facts": with_facts() + facts,
        "etl_replay_facts": with_facts() + facts,
        "etl_resubmit_rollup": rollup,
        "etl_replay_rollup": rollup,
    }
