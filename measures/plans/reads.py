"""Readers over stored measurements (P2-P5, O3, S19; R1, R2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.functions.serialize import to_api_rows

READER_COLUMNS = ("id", "study_id", "participant_id", "measurement_type", "value", "unit",
                  "timestamp", "site_id", "quality_score", "processed_at")
RESULT_CAP = 1000  # newest rows returned per read


def measurement_filter(study_id: str | None = None, participant_id: str | None = None,
                       measurement_type: str | None = None, start_date: str | None = None,
                       end_date: str | None = None, site_id: str | None = None,
                       unit: str | None = None, min_quality: float | None = None):
    """Conjunction of the filters that are given; empty means absent.

    A bare date bound means midnight, so `end_date='2024-01-16'` excludes the
    rest of that day.  A zone in a bound is dropped, as for a zone-less column.
    """
    preds = []
    for col, v in (("study_id", study_id), ("participant_id", participant_id),
                   ("measurement_type", measurement_type), ("site_id", site_id),
                   ("unit", unit)):
        if v:
            preds.append(F.col(col) == F.lit(v))
    if start_date:
        preds.append(F.col("timestamp") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        preds.append(F.col("timestamp") <= F.lit(end_date).cast("timestamp_ntz"))
    if min_quality is not None and min_quality != "":
        preds.append(F.col("quality_score") >= F.lit(min_quality))
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def query_measurements(facts: DataFrame, limit: int | None = RESULT_CAP,
                       api_layout: bool = False, **filters) -> DataFrame:
    """Filtered measurements, newest first, capped at 1000 rows (the cap
    is the feature: a top-k read, planned as TakeOrderedAndProject).
    `id` breaks timestamp ties so the cut is deterministic."""
    cols = [c for c in READER_COLUMNS if c in facts.columns]
    out = (facts.where(measurement_filter(**filters)).select(*cols)
           .orderBy(F.desc("timestamp"), F.asc("id")))
    if limit is not None:
        out = out.limit(limit)
    return to_api_rows(out) if api_layout else out


def study_measurements(facts: DataFrame, study_id: str, **kw) -> DataFrame:
    """R2: all (newest 1000) measurements of one study."""
    return query_measurements(facts, study_id=study_id, **kw)


def study_exists(facts: DataFrame, study_id: str) -> bool:
    """P5: "not found" test for R2 without counting the study."""
    return not facts.where(F.col("study_id") == study_id).isEmpty()
