"""The recurring analytic questions Q1-Q7, each over raw rows and over the
daily roll-up.  Parameters replace the literals of the original SQL.

`digits` rounds double averages for presentation; None keeps them as
computed.  Sorts are part of the question (O1/O2); Spark sorts with a range
shuffle, so an ORDER BY never funnels the data through one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measures.functions.parsing import as_day


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


# Q1 -------------------------------------------------------------------------
def quality_by_study(facts: DataFrame) -> DataFrame:
    """Q1 raw: average quality (3 places) and row count per study, best first."""
    return (facts.groupBy("study_id")
            .agg(F.round(F.try_divide(F.sum("quality_score"), F.count("quality_score")), 3)
                 .cast("double").alias("avg_qs"),
                 F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("avg_qs")))


def quality_by_study_rollup(rollup: DataFrame, digits: int | None = None) -> DataFrame:
    """Q1 roll-up: unweighted mean of daily averages; `rows` counts buckets."""
    return (rollup.groupBy("study_id")
            .agg(_round(F.avg("avg_quality_score"), digits).alias("avg_qs"),
                 F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("avg_qs")))


# Q2 -------------------------------------------------------------------------
def daily_trend(facts: DataFrame, participant_id: str = "P001",
                measurement_type: str = "glucose", digits: int | None = None) -> DataFrame:
    """Q2 raw: daily average value of one participant and type."""
    return (facts.where((F.col("participant_id") == participant_id)
                        & (F.col("measurement_type") == measurement_type))
            .groupBy(as_day("timestamp").alias("day"))
            .agg(_round(F.avg("value_num"), digits).alias("avg_glucose_mg_dl"))
            .orderBy("day"))


def daily_trend_rollup(rollup: DataFrame, participant_id: str = "P001",
                       measurement_type: str = "glucose", digits: int | None = None) -> DataFrame:
    """Q2 roll-up: count-weighted average of the day's buckets (A10)."""
    return (rollup.where((F.col("participant_id") == participant_id)
                         & (F.col("measurement_type") == measurement_type))
            .groupBy(F.col("agg_day").alias("day"))
            .agg(_round(F.sum(F.col("avg_value") * F.col("measurement_count"))
                        / F.sum("measurement_count"), digits).alias("avg_glucose_mg_dl"))
            .orderBy("day"))


# Q3 -------------------------------------------------------------------------
def counts_by_site(facts: DataFrame) -> DataFrame:
    """Q3 raw: measurements per site, largest first."""
    return (facts.groupBy("site_id").agg(F.count(F.lit(1)).alias("measurement_count"))
            .orderBy(F.desc("measurement_count")))


def counts_by_site_rollup(rollup: DataFrame) -> DataFrame:
    """Q3 roll-up: sum of bucket counts per site."""
    return (rollup.groupBy("site_id")
            .agg(F.sum("measurement_count").cast("long").alias("measurement_count"))
            .orderBy(F.desc("measurement_count")))


# Q4 -------------------------------------------------------------------------
def low_quality_buckets(rollup: DataFrame) -> DataFrame:
    """Q4: roll-up buckets holding at least one low-quality reading."""
    # The bucket key completes the sort key: the order is total, and the
    # range partitioner can split a run of equal leading keys across tasks.
    return (rollup.where(F.col("low_quality_count") > 0)
            .orderBy("agg_day", "study_id", "participant_id", "site_id", "measurement_type"))


# Q5 -------------------------------------------------------------------------
def recent_measurements(facts: DataFrame, days: int = 30,
                        as_of: dt.date | str | None = None) -> DataFrame:
    """Q5: rows at or after midnight `days` days before `as_of` (default today).

    The bound is a literal at planning time, so it reaches the Parquet scan as
    a pushed filter and prunes row groups of timestamp-sorted files.
    """
    start = (F.date_sub(F.current_date(), days) if as_of is None
             else F.date_sub(F.lit(str(as_of)).cast("date"), days))
    # `id` completes the sort key: many rows sharing one timestamp (a bulk
    # import) are still split across range partitions, not sorted in one task.
    return (facts.where(F.col("timestamp") >= start.cast("timestamp_ntz"))
            .orderBy("timestamp", "id"))


# Q6 -------------------------------------------------------------------------
def participants_per_study(enrollments: DataFrame) -> DataFrame:
    """Q6: enrolled participants per study, largest first."""
    return (enrollments.groupBy("study_id").agg(F.count(F.lit(1)).alias("participants"))
            .orderBy(F.desc("participants")))


# Q7 -------------------------------------------------------------------------
def bmi(weight: str = "weight_kg", height: str = "height_cm") -> Column:
    """Kg / (cm / 100)^2 on doubles."""
    return F.col(weight) / F.pow(F.col(height) / 100, 2)


def latest_value(df: DataFrame, keys: list[str], value: str, order: list[str],
                 alias: str) -> DataFrame:
    """Latest row's value per key (W1/W2, `DISTINCT ON ... ORDER BY ... DESC`).

    An aggregate (`max_by` over a struct of the ordering columns, last one the
    tie-break), not a window: it combines partially before the shuffle, so a
    key holding a third of the rows is never sorted whole in one task.
    """
    return df.groupBy(*keys).agg(
        F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias(alias))


def mean_bmi(facts: DataFrame, study_id: str = "STUDY001") -> DataFrame:
    """Q7 raw: mean BMI over participants with both a latest weight and a
    latest height in the study (W1 + J1 + S10 + A15)."""
    scoped = facts.where((F.col("study_id") == study_id)
                         & F.col("measurement_type").isin("weight", "height"))
    # One scan and one shuffle: a participant without one of the two has a
    # NULL there, so a NULL index, which the average leaves out (as J1 would).
    both = scoped.groupBy("participant_id").agg(
        _latest_of("weight").alias("weight_kg"), _latest_of("height").alias("height_cm"))
    return both.agg(F.round(F.avg(bmi()), 2).alias("avg_bmi"))


def _latest_of(kind: str) -> Column:
    return F.expr("max_by(value_num, struct(timestamp, id)) "
                  f"FILTER (WHERE measurement_type = '{kind}')")


def latest_weight_and_height(facts: DataFrame, study_id: str = "STUDY001") -> DataFrame:
    """J1 itself: each participant's latest weight joined with the latest height."""
    latest = latest_value(
        facts.where((F.col("study_id") == study_id)
                    & F.col("measurement_type").isin("weight", "height")),
        ["participant_id", "measurement_type"], "value_num", ["timestamp", "id"], "v")
    weight = latest.where(F.col("measurement_type") == "weight").select(
        "participant_id", F.col("v").alias("weight_kg"))
    height = latest.where(F.col("measurement_type") == "height").select(
        "participant_id", F.col("v").alias("height_cm"))
    return weight.join(height, "participant_id", "inner")


def mean_bmi_rollup(rollup: DataFrame, study_id: str = "STUDY001") -> DataFrame:
    """Q7 roll-up: latest daily bucket per (participant, type), pivoted by
    conditional MAX, kept when both types exist (W2 + A14 + P11 + A15)."""
    scoped = rollup.where((F.col("study_id") == study_id)
                          & F.col("measurement_type").isin("weight", "height"))
    latest = latest_value(scoped, ["participant_id", "measurement_type"], "avg_value",
                          ["agg_day", "site_id"], "value_num")
    pivot = (latest.groupBy("participant_id")
             .agg(F.max(F.when(F.col("measurement_type") == "weight", F.col("value_num")))
                  .alias("weight_kg"),
                  F.max(F.when(F.col("measurement_type") == "height", F.col("value_num")))
                  .alias("height_cm"),
                  F.count(F.lit(1)).alias("n"))
             .where(F.col("n") == 2))
    return pivot.agg(F.round(F.avg(bmi()), 2).alias("avg_bmi"))
