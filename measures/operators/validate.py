"""Typing of landing rows and the per-file verdict.

A file is one job and is accepted or rejected whole (trap T9): row-level
problems are turned into flags, and one `groupBy(job_id)` folds the flags into
a verdict row per file.  Only verdicts -- one row per file -- leave this
module; rows never go to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measures.functions.ids import measurement_hash, uuid_layout
from measures.functions.parsing import (batch_instant, bp_overflow, bp_part, clamp_quality,
                                        null_if_missing, parse_timestamp_utc, strip_ws,
                                        value_num)
from measures.schema import (NOT_NULL_COLUMNS, PROGRESS, RANGE_LIMITS, STRIPPED_COLUMNS,
                             VALID_MEASUREMENT_TYPES, VARCHAR_LIMITS)

STAGE_EXTRACT, STAGE_TRANSFORM, STAGE_VALIDATE, STAGE_LOAD = (
    "extract", "transform", "validate", "load")
# Progress a failed job keeps: that of its last finished stage.
FAILED_PROGRESS = {STAGE_EXTRACT: PROGRESS["started"], STAGE_TRANSFORM: PROGRESS["extracted"],
                   STAGE_VALIDATE: PROGRESS["transformed"], STAGE_LOAD: PROGRESS["validated"]}


def transform(rows: DataFrame, instant=None) -> DataFrame:
    """Type landing rows: missing tokens -> NULL, strip 5 text columns, parse
    the timestamp to UTC, clamp quality, derive value_num / blood pressure,
    stamp processed_at / created_at and compute the id."""
    # Step by step: an expression that a later one names more than once is a
    # column by then, or each mention would be evaluated anew in every row.
    rows = rows.select("job_id", "_too_long", "_has_id", *[null_if_missing(c).alias(c) for c in (
        "study_id", "participant_id", "measurement_type", "value", "unit", "timestamp", "site_id",
        "quality_score", "id")])
    txt = {c: strip_ws(c) if c in STRIPPED_COLUMNS else F.col(c) for c in rows.columns}
    stamp = batch_instant(instant)
    # File-level facts (path, header) stay out of the rows: a persisted
    # batch should not repeat them per row.
    typed = rows.select(
        "job_id", "_too_long", "_has_id",
        file_uuid("id").alias("_file_id"),
        *[txt[c].alias(c) for c in ("study_id", "participant_id", "site_id", "measurement_type",
                                    "value", "unit")],
        parse_timestamp_utc(txt["timestamp"]).alias("timestamp"),
        clamp_quality(txt["quality_score"]).alias("quality_score"),
        stamp.alias("processed_at"), stamp.alias("created_at"))
    hashed = typed.select("*", F.when(~F.col("_has_id"), measurement_hash()).alias("_hash"))
    return hashed.select(
        F.when(F.col("_has_id"), F.col("_file_id")).otherwise(uuid_layout(F.col("_hash")))
        .alias("id"), *[c for c in typed.columns if c != "_file_id"],
        (F.col("_has_id") & F.col("_file_id").isNull()).alias("_bad_id"),
        value_num("value").alias("value_num"),
        bp_part("value", 1).alias("bp_systolic"), bp_part("value", 2).alias("bp_diastolic"),
        bp_overflow("value").alias("_bp_overflow"))


def file_uuid(c: Column | str) -> Column:
    """A file-supplied id in canonical UUID text (lower case, 8-4-4-4-12), or
    NULL when it is missing or not 32 hex digits once braces and hyphens are
    removed."""
    digits = F.lower(F.regexp_replace(strip_ws(c), r"[{}-]", ""))
    return F.when(digits.rlike(r"^[0-9a-f]{32}\z"), uuid_layout(digits))


def _names_where(flags: dict[str, Column]) -> Column:
    """Array of the names whose flag is true (fixed order)."""
    return F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in flags.items()]),
                    lambda x: x.isNotNull())


def python_list(arr: Column) -> Column:
    """Render an array of strings like a Python list: ['a', 'b']."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def file_verdicts(typed: DataFrame) -> DataFrame:
    """V1-V5 + T9/T17/T22: one verdict row per job.

    Output: job_id, rows, stage (NULL when the file passes), message,
    progress, bad_types, and what the file touches: studies, days, min_ts,
    max_ts.  Check order follows the job's stages: extraction
    (over-long rows), timestamps, measurement types, then load constraints
    (NOT NULL, VARCHAR length, INT overflow).  Missing columns are a property
    of the file's header and are judged per file by the caller (they rank
    after extraction errors); duplicate ids are checked later among the files
    that pass (constraints.resolve_duplicates).
    """
    bad_type = F.col("measurement_type").isNotNull() & ~F.col("measurement_type").isin(
        *VALID_MEASUREMENT_TYPES)
    agg = typed.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_too_long").alias("too_long"),
        F.max(F.col("timestamp").isNull()).alias("bad_ts"),
        F.array_sort(F.collect_set(F.when(bad_type, F.col("measurement_type"))))
        .alias("bad_types"),
        *[F.max(F.col(c).isNull()).alias(f"null_{c}") for c in NOT_NULL_COLUMNS],
        *[F.max(F.length(c) > n).alias(f"long_{c}") for c, n in VARCHAR_LIMITS.items()],
        F.max("_bp_overflow").alias("bp_overflow"),
        F.max("_bad_id").alias("bad_id"),
        # What a load of this file touches (a few studies, its calendar
        # span): lets the load prune stored partitions without extra passes.
        F.array_sort(F.collect_set("study_id")).alias("studies"),
        F.array_sort(F.collect_set(F.to_date("timestamp"))).alias("days"),
        F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))
    types_msg = F.concat(F.lit("Invalid types: "), python_list(F.col("bad_types")))
    has_bad_types = F.size("bad_types") > 0
    load_errors = F.concat(
        F.transform(_names_where({c: F.col(f"null_{c}") for c in NOT_NULL_COLUMNS}),
                    lambda c: F.concat(F.lit('null value in column "'), c,
                                       F.lit('" violates not-null constraint'))),
        F.transform(_names_where({c: F.col(f"long_{c}") for c in VARCHAR_LIMITS}),
                    lambda c: F.concat(F.lit('value too long for column "'), c, F.lit('"'))),
        F.when(F.col("bp_overflow"),
               F.array(F.lit('integer out of range in blood pressure "value"')))
        .otherwise(F.array().cast("array<string>")),
        F.when(F.col("bad_id"), F.array(F.lit('missing or invalid uuid in column "id"')))
        .otherwise(F.array().cast("array<string>")))
    stage = (F.when(F.col("too_long"), F.lit(STAGE_EXTRACT))
             .when(F.col("bad_ts"), F.lit(STAGE_TRANSFORM))
             .when(has_bad_types, F.lit(STAGE_VALIDATE))
             .when(F.size(load_errors) > 0, F.lit(STAGE_LOAD)))
    message = (F.when(F.col("too_long"),
                      F.lit("Extraction error: a row has more fields than the header"))
               .when(F.col("bad_ts"), F.lit("Transform error: unreadable or missing timestamp"))
               .when(has_bad_types, types_msg)
               .when(F.size(load_errors) > 0,
                     F.concat(F.lit("Load error: "), F.array_join(load_errors, "; "))))
    progress = F.coalesce(
        *[F.when(stage == s, F.lit(p)) for s, p in FAILED_PROGRESS.items()],
        F.lit(PROGRESS["validated"]))
    return agg.select("job_id", "rows", stage.alias("stage"), message.alias("message"),
                      progress.cast("int").alias("progress"), "bad_types", "studies", "days",
                      "min_ts", "max_ts")


def range_report(facts: DataFrame) -> DataFrame:
    """V9: readings outside the declared range, per type.  Report only; the
    reference declares the limits but never gates on them.  Blood pressure is
    judged on the systolic reading.  The six limits are a literal map, so the
    lookup stays inside generated code (no join)."""
    low = F.create_map(*[x for t, (lo, _) in RANGE_LIMITS.items()
                         for x in (F.lit(t), F.lit(float(lo)))])
    high = F.create_map(*[x for t, (_, hi) in RANGE_LIMITS.items()
                          for x in (F.lit(t), F.lit(float(hi)))])
    mtype = F.col("measurement_type")
    reading = F.when(mtype == "blood_pressure",
                     F.col("bp_systolic").cast("double")).otherwise(F.col("value_num"))
    return (facts.where(mtype.isin(*RANGE_LIMITS))
            .select(mtype, reading.alias("reading"), F.element_at(low, mtype).alias("low"),
                    F.element_at(high, mtype).alias("high"))
            .groupBy("measurement_type")
            .agg(F.count("reading").alias("readings"),
                 F.sum((F.col("reading") < F.col("low")).cast("long")).alias("below_range"),
                 F.sum((F.col("reading") > F.col("high")).cast("long")).alias("above_range")))
