"""Write measurements as landing CSV files, one folder per job.

The counterpart of the landing scan: each job folder is named
`<job uuid>_<name>` and holds the job's part files, each with a header.
Used to stage data for loads (and by the registered end-to-end queries,
which stage the adapter's measurements).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measures.functions.ids import uuid_layout

LANDING_COLUMNS = ("study_id", "participant_id", "measurement_type", "value", "unit",
                   "timestamp", "site_id", "quality_score")
ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
JOB_DIR = "landing_job"


def job_uuid(name: Column) -> Column:
    """Deterministic job id from a job name."""
    return uuid_layout(F.md5(name))


def write_landing(measurements: DataFrame, job_name: Column, folder: str) -> None:
    """One folder per distinct `job_name`; text columns as stored, the
    timestamp as ISO-8601 UTC with microseconds, quality as text."""
    name = job_name
    out = measurements.select(
        *[F.col(c) for c in LANDING_COLUMNS if c not in ("timestamp", "quality_score")],
        F.date_format("timestamp", ISO_MICROS_Z).alias("timestamp"),
        F.col("quality_score").cast("string").alias("quality_score"),
        F.concat(job_uuid(name), F.lit("_"), name).alias(JOB_DIR))
    # Few files per job; a job that is unusually large is split over tasks.
    (out.select(*LANDING_COLUMNS, JOB_DIR).hint("rebalance", JOB_DIR)
     .write.mode("errorifexists").option("header", True).partitionBy(JOB_DIR).csv(folder))
