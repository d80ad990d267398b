"""Reader row layout (S19): camelCase names, quality as text, ISO-8601 UTC
timestamps with milliseconds and a `Z`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's reader output) -----------------
# Timestamp layout of a reader row, and stored column -> reader field names.
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
API_FIELDS = (
    ("id", "id"), ("study_id", "studyId"), ("participant_id", "participantId"),
    ("measurement_type", "measurementType"), ("value", "value"), ("unit", "unit"),
    ("timestamp", "timestamp"), ("site_id", "siteId"), ("quality_score", "qualityScore"),
    ("processed_at", "processedAt"),
)
# -----------------------------------------------------------------------------


def iso_z(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, ISO_MILLIS_Z)


def to_api_rows(df: DataFrame) -> DataFrame:
    """Project stored measurements into the reader layout (fields absent from
    the input, such as processed_at on derived data, are left out)."""
    cols = []
    for src, dst in API_FIELDS:
        if src not in df.columns:
            continue
        if src in ("timestamp", "processed_at"):
            cols.append(iso_z(src).alias(dst))
        elif src == "quality_score":
            cols.append(F.col(src).cast("string").alias(dst))
        else:
            cols.append(F.col(src).alias(dst))
    return df.select(*cols)


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON document per row, for handing results to a service."""
    return to_api_rows(df).select(F.to_json(F.struct("*")).alias("json"))
