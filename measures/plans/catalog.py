"""Registered queries over the driver tables (Spark forms; their DuckDB twins
are in `oracle`, the shared parameters in `params`).

Each entry is (spark, sf_dir) -> DataFrame and reads the whole `events` table
through the adapter; nothing is sampled or capped except where the cap is the
feature (R1/R2 return the newest 1000 rows).  Double averages are rounded to 6
places in the registered form so summation order cannot change the result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from measures.operators import constraints, dimensions, ledger, rollup, validate
from measures.plans import analytics, dirty, loading, reads, scenarios
from measures.plans.params import (AM_SPLIT_HOUR, BMI_STUDY, FIRST_LOAD_END, LOOKUP_JOB,
                                   LOAD_INSTANT, READ_FILTERS, RECENT_AS_OF, RECENT_DAYS, STREAM_LATENESS,
                                   STUDY_READ, TREND_PARTICIPANT, TREND_TYPE)
from measures.session import ensure_session, scratch_dir
from measures.sinks.landing import write_landing
from measures.sources import adapter
from measures.sources.store import Store
from measures.streaming import start_ingest, stream_facts, streaming_daily_rollup


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session(spark)
    return adapter.facts_from_dir(spark, sf_dir).drop("event_id")


def _rollup(spark, sf_dir):
    return rollup.daily_rollup(_facts(spark, sf_dir))


def _am(df: DataFrame) -> DataFrame:
    return df.where(F.hour("timestamp") < AM_SPLIT_HOUR)


def _pm(df: DataFrame) -> DataFrame:
    return df.where(F.hour("timestamp") >= AM_SPLIT_HOUR)


# --- Spark side ---------------------------------------------------------------
def q_facts(spark, d):
    return _facts(spark, d)


def q_daily_rollup(spark, d):
    return round_doubles(_rollup(spark, d))


def q_rollup_merge_faithful(spark, d):
    f = _facts(spark, d)
    return round_doubles(rollup.merge_faithful(rollup.daily_rollup(_am(f)),
                                               rollup.daily_rollup(_pm(f))))


def q_rollup_merge_exact(spark, d):
    f = _facts(spark, d)
    merged = rollup.merge_exact(rollup.rollup_partials(_am(f)), rollup.rollup_partials(_pm(f)))
    return round_doubles(rollup.finalize_partials(merged))


def q_enrollments(spark, d):
    f = _facts(spark, d)
    return dimensions.merge_enrollments(dimensions.first_seen(_am(f)),
                                        dimensions.first_seen(_pm(f)))


def q_new_participants(spark, d):
    f = _facts(spark, d)
    first = F.col("timestamp") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    return dimensions.insert_if_absent(f.where(first).select("participant_id"), f.where(~first),
                                       "participant_id")


def q1(spark, d):
    return analytics.quality_by_study(_facts(spark, d))


def q1_rollup(spark, d):
    return analytics.quality_by_study_rollup(_rollup(spark, d), digits=6)


def q2(spark, d):
    return analytics.daily_trend(_facts(spark, d), TREND_PARTICIPANT, TREND_TYPE, digits=6)


def q2_rollup(spark, d):
    return analytics.daily_trend_rollup(_rollup(spark, d), TREND_PARTICIPANT, TREND_TYPE, digits=6)


def q3(spark, d):
    return analytics.counts_by_site(_facts(spark, d))


def q3_rollup(spark, d):
    return analytics.counts_by_site_rollup(_rollup(spark, d))


def q4(spark, d):
    return round_doubles(analytics.low_quality_buckets(_rollup(spark, d)))


def q5(spark, d):
    return analytics.recent_measurements(_facts(spark, d), RECENT_DAYS, RECENT_AS_OF)


def q6(spark, d):
    return analytics.participants_per_study(dimensions.first_seen(_facts(spark, d)))


def q7(spark, d):
    return analytics.mean_bmi(_facts(spark, d), BMI_STUDY)


def q7_rollup(spark, d):
    return analytics.mean_bmi_rollup(_rollup(spark, d), BMI_STUDY)


def r1(spark, d):
    return reads.query_measurements(_facts(spark, d), **READ_FILTERS)


def r1_api(spark, d):
    return reads.query_measurements(_facts(spark, d), api_layout=True, **READ_FILTERS)


def r2(spark, d):
    return reads.study_measurements(_facts(spark, d), STUDY_READ)


# --- End to end: landing files derived from events -> two loads -> tables -------
_LOADED: dict[tuple, Store] = {}


def _job_name(df: DataFrame) -> Column:
    half = F.when(F.hour("timestamp") < AM_SPLIT_HOUR, F.lit("am")).otherwise(F.lit("pm"))
    return F.concat_ws("_", F.col("study_id"), F.to_date("timestamp").cast("string"), half)


def loaded_store(spark: SparkSession, sf_dir: str) -> Store:
    """Stage the adapter's measurements as landing files (one job per study,
    day and half-day), then load the morning files and the afternoon files
    as two loads, so the second merges into stored day partitions.  The store
    lives in the shared scratch folder; one per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        ensure_session(spark)
        base = scratch_dir(spark, "etl")
        m = adapter.measurements(adapter.read_events(spark, sf_dir)).drop("event_id")
        write_landing(_am(m), _job_name(m), f"{base}/landing_am")
        write_landing(_pm(m), _job_name(m), f"{base}/landing_pm")
        store = Store(f"{base}/store")
        for half in ("am", "pm"):
            loading.run_load(spark, f"{base}/landing_{half}", store, load_id=half,
                             instant=LOAD_INSTANT)
        _LOADED[key] = store
    return _LOADED[key]


def q_etl_rollup_exact(spark, d):
    """The same two loads into a second store, with the exact roll-up rule:
    the stored roll-up must equal a single recompute over all rows."""
    store = loaded_store(spark, d)
    base = store.root.rsplit("/", 1)[0]
    key = (spark.sparkContext.applicationId, d, "exact")
    if key not in _LOADED:
        exact = Store(f"{base}/store_exact")
        loading.run_load(spark, f"{base}/landing_am", exact, load_id="am", rollup_rule="exact")
        loading.run_load(spark, f"{base}/landing_pm", exact, load_id="pm", rollup_rule="exact")
        _LOADED[key] = exact
    return round_doubles(_LOADED[key].rollup(spark))


def q_etl_facts(spark, d):
    store = loaded_store(spark, d)
    return store.measurements(spark).select(
        "id", "study_id", "participant_id", "site_id", "measurement_type", "value", "unit",
        "timestamp", "quality_score", "value_num", "bp_systolic", "bp_diastolic", "job_id")


def q_etl_rollup(spark, d):
    return round_doubles(loaded_store(spark, d).rollup(spark))


def q_etl_enrollments(spark, d):
    return loaded_store(spark, d).enrollments(spark)


def q_etl_jobs(spark, d):
    jobs = ledger.current_jobs(loaded_store(spark, d).jobs(spark))
    return jobs.select("job_id", "filename", "status", "progress", "message", "error_message")


def q_etl_job_lookup(spark, d):
    store = loaded_store(spark, d)
    job = str(uuid.UUID(hashlib.md5(LOOKUP_JOB.encode()).hexdigest()))
    return ledger.job_by_id(store.jobs(spark), job).select("id", "filename", "study_id",
                                                           "status", "error_message")


def q_etl_job_status(spark, d):
    store = loaded_store(spark, d)
    return ledger.job_status(store.jobs(spark))


def q_fk_orphans(spark, d):
    s = loaded_store(spark, d)
    return constraints.fk_orphans(s.measurements(spark), s.read(spark, "studies"),
                                  s.read(spark, "sites"), s.read(spark, "participants"),
                                  s.enrollments(spark))


def q_range_report(spark, d):
    return validate.range_report(_facts(spark, d))


def q_stream_ingest_facts(spark, d):
    """X1 over the staged landing files (both halves): one micro-batch, one load."""
    store = loaded_store(spark, d)
    base = store.root.rsplit("/", 1)[0]
    key = (spark.sparkContext.applicationId, d, "stream")
    if key not in _LOADED:
        streamed = Store(f"{base}/store_stream")
        q = start_ingest(spark, f"{base}/landing_*", streamed, checkpoint=f"{base}/ckpt_ingest")
        q.awaitTermination()
        _LOADED[key] = streamed
    return q_etl_facts_from(_LOADED[key], spark)


def q_stream_daily_rollup(spark, d):
    """Watermarked daily roll-up over the stored facts as a stream, appended
    to a Parquet sink; only days closed by the watermark are emitted."""
    store = loaded_store(spark, d)
    base = store.root.rsplit("/", 1)[0]
    key = (spark.sparkContext.applicationId, d, "rollup_stream")
    if key not in _LOADED:
        out = f"{base}/rollup_stream"
        q = (streaming_daily_rollup(stream_facts(spark, store), lateness=STREAM_LATENESS)
             .writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", f"{base}/ckpt_rollup").trigger(availableNow=True)
             .start())
        q.awaitTermination()
        _LOADED[key] = Store(out)
    return round_doubles(spark.read.parquet(_LOADED[key].root))


def q_etl_facts_from(store: Store, spark) -> DataFrame:
    return store.measurements(spark).select(
        "id", "study_id", "participant_id", "site_id", "measurement_type", "value", "unit",
        "timestamp", "quality_score", "value_num", "bp_systolic", "bp_diastolic", "job_id")


# Analytic queries over the stored, partitioned tables of the two loads.
def q_stored_q1(spark, d):
    return analytics.quality_by_study(loaded_store(spark, d).measurements(spark))


def q_stored_q1_rollup(spark, d):
    return analytics.quality_by_study_rollup(loaded_store(spark, d).rollup(spark), digits=6)


def q_stored_q2_rollup(spark, d):
    return analytics.daily_trend_rollup(loaded_store(spark, d).rollup(spark), TREND_PARTICIPANT,
                                        TREND_TYPE, digits=6)


def q_stored_q3_rollup(spark, d):
    return analytics.counts_by_site_rollup(loaded_store(spark, d).rollup(spark))


def q_stored_q4(spark, d):
    return round_doubles(analytics.low_quality_buckets(loaded_store(spark, d).rollup(spark)))


def q_stored_q5(spark, d):
    s = loaded_store(spark, d)
    return analytics.recent_measurements(q_etl_facts_from(s, spark).drop("job_id"), RECENT_DAYS,
                                         RECENT_AS_OF)


def q_stored_q6(spark, d):
    return analytics.participants_per_study(loaded_store(spark, d).enrollments(spark))


def q_stored_q7(spark, d):
    return analytics.mean_bmi(loaded_store(spark, d).measurements(spark), BMI_STUDY)


def q_stored_q7_rollup(spark, d):
    return analytics.mean_bmi_rollup(loaded_store(spark, d).rollup(spark), BMI_STUDY)


def q_stored_r1(spark, d):
    return reads.query_measurements(loaded_store(spark, d).measurements(spark),
                                    **READ_FILTERS)


def q_stored_r2(spark, d):
    return reads.study_measurements(loaded_store(spark, d).measurements(spark),
                                    STUDY_READ)


def _sql(name: str, **params):
    """A Spark SQL statement over views of the loaded store."""
    def run(spark, d):
        from measures.plans import sql
        store = loaded_store(spark, d)
        prefix = f"s{hashlib.md5(store.root.encode()).hexdigest()[:12]}_"
        sql.register_views(spark, store, prefix)
        out = sql.run(spark, name, prefix, **params)
        if name in ("q4",):
            out = round_doubles(out.drop("load_id"))
        if name in ("q5",):
            out = out.select(*_FACT_COLS_LIST)
        return out
    return run


_FACT_COLS_LIST = ("id", "study_id", "participant_id", "site_id", "measurement_type", "value",
                   "unit", "timestamp", "quality_score", "value_num", "bp_systolic",
                   "bp_diastolic")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "facts": q_facts,
    "daily_rollup": q_daily_rollup,
    "rollup_merge_faithful": q_rollup_merge_faithful,
    "rollup_merge_exact": q_rollup_merge_exact,
    "enrollments": q_enrollments,
    "new_participants": q_new_participants,
    "q1_quality_by_study": q1,
    "q1_quality_by_study_rollup": q1_rollup,
    "q2_trend": q2,
    "q2_trend_rollup": q2_rollup,
    "q3_counts_by_site": q3,
    "q3_counts_by_site_rollup": q3_rollup,
    "q4_low_quality": q4,
    "q5_recent": q5,
    "q6_participants": q6,
    "q7_mean_bmi": q7,
    "q7_mean_bmi_rollup": q7_rollup,
    "r1_measurements": r1,
    "r1_measurements_api": r1_api,
    "r2_study": r2,
    "etl_facts": q_etl_facts,
    "etl_rollup": q_etl_rollup,
    "etl_rollup_exact": q_etl_rollup_exact,
    "etl_enrollments": q_etl_enrollments,
    "etl_jobs": q_etl_jobs,
    "etl_job_lookup": q_etl_job_lookup,
    "etl_job_status": q_etl_job_status,
    "fk_orphans": q_fk_orphans,
    "range_report": q_range_report,
    "stream_ingest_facts": q_stream_ingest_facts,
    "stream_daily_rollup": q_stream_daily_rollup,
    "stored_q1_quality_by_study": q_stored_q1,
    "stored_q1_quality_by_study_rollup": q_stored_q1_rollup,
    "stored_q2_trend_rollup": q_stored_q2_rollup,
    "stored_q3_counts_by_site_rollup": q_stored_q3_rollup,
    "stored_q4_low_quality": q_stored_q4,
    "stored_q5_recent": q_stored_q5,
    "stored_q6_participants": q_stored_q6,
    "stored_q7_mean_bmi": q_stored_q7,
    "stored_q7_mean_bmi_rollup": q_stored_q7_rollup,
    "stored_r1_measurements": q_stored_r1,
    "stored_r2_study": q_stored_r2,
    "sql_q1_quality_by_study": _sql("q1_raw"),
    "sql_q1_quality_by_study_rollup": _sql("q1_rollup"),
    "sql_q2_trend": _sql("q2_raw", participant=TREND_PARTICIPANT, mtype=TREND_TYPE),
    "sql_q2_trend_rollup": _sql("q2_rollup", participant=TREND_PARTICIPANT, mtype=TREND_TYPE),
    "sql_q3_counts_by_site": _sql("q3_raw"),
    "sql_q3_counts_by_site_rollup": _sql("q3_rollup"),
    "sql_q4_low_quality": _sql("q4"),
    "sql_q5_recent": _sql("q5", days=RECENT_DAYS, as_of=RECENT_AS_OF.isoformat()),
    "sql_q6_participants": _sql("q6"),
    "sql_q7_mean_bmi": _sql("q7_raw", study=BMI_STUDY),
    "sql_q7_mean_bmi_rollup": _sql("q7_rollup", study=BMI_STUDY),
}
QUERIES |= dirty.QUERIES | scenarios.QUERIES
QUERIES["j1_latest_weight_height"] = lambda spark, d: round_doubles(
    analytics.latest_weight_and_height(_facts(spark, d), BMI_STUDY))
