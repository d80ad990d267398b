"""Dimension and enrollment maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """A2: the distinct non-NULL values of one key column."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def insert_if_absent(existing: DataFrame | None, incoming: DataFrame, key: str) -> DataFrame:
    """J2 (`ON CONFLICT DO NOTHING`): keys of `incoming` not yet in `existing`.

    A left anti join; Catalyst broadcasts the smaller side only when its
    measured size is under the broadcast threshold, else it shuffles both.
    """
    keys = distinct_keys(incoming, key)
    if existing is None:
        return keys
    return keys.join(existing.select(key), key, "left_anti")


def first_seen(facts: DataFrame) -> DataFrame:
    """A3: first measurement time per (participant, study)."""
    return (facts.groupBy("participant_id", "study_id")
            .agg(F.min("timestamp").alias("enrolled_at")))


def merge_enrollments(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """A4: upsert keeping the earliest enrolment.  MIN is associative, so a
    union and a re-aggregation replace the outer join."""
    if old is None:
        return new
    return (old.select("participant_id", "study_id", "enrolled_at")
            .unionByName(new.select("participant_id", "study_id", "enrolled_at"))
            .groupBy("participant_id", "study_id")
            .agg(F.min("enrolled_at").alias("enrolled_at")))
