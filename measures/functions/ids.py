"""Deterministic measurement id.

The id is the MD5 of five pipe-joined fields -- study, participant, UTC
timestamp, type and the raw value text -- printed in UUID layout (8-4-4-4-12
hex digits, no version bits set).  Site, unit and quality do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's for identical ids) ------------
# Field order in the hash: study_id, participant_id, timestamp,
# measurement_type, value; separator "|".  Timestamp text inside the hash:
# "yyyy-MM-dd HH:mm:ss+00:00", with ".ffffff" before the offset when the
# fraction of a second is not zero.
_SEPARATOR = "|"
_SECOND_TEXT = "yyyy-MM-dd HH:mm:ss"
_FRACTION_TEXT = "SSSSSS"
_UTC_SUFFIX = "+00:00"
# -----------------------------------------------------------------------------


def utc_text(ts: Column | str = "timestamp") -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(ts, _SECOND_TEXT)
    fraction = F.when(F.date_trunc("second", ts) != ts,
                      F.concat(F.lit("."), F.date_format(ts, _FRACTION_TEXT))).otherwise(F.lit(""))
    return F.concat(whole, fraction, F.lit(_UTC_SUFFIX))


def uuid_layout(hex32: Column) -> Column:
    return F.concat_ws("-", F.substring(hex32, 1, 8), F.substring(hex32, 9, 4),
                       F.substring(hex32, 13, 4), F.substring(hex32, 17, 4),
                       F.substring(hex32, 21, 12))


def measurement_id(study: str = "study_id", participant: str = "participant_id",
                   ts: str = "timestamp", mtype: str = "measurement_type",
                   value: str = "value") -> Column:
    """Deterministic id of a measurement row.  Key fields must be non-NULL
    (the gate rejects files with NULL keys before ids are used)."""
    return uuid_layout(measurement_hash(study, participant, ts, mtype, value))


def measurement_hash(study: str = "study_id", participant: str = "participant_id",
                     ts: str = "timestamp", mtype: str = "measurement_type",
                     value: str = "value") -> Column:
    """The 32 hex digits of a row's id."""
    return F.md5(F.concat_ws(_SEPARATOR, F.col(study), F.col(participant), utc_text(ts),
                             F.col(mtype), F.col(value)))
