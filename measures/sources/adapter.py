"""Driver tables -> clinical measurements.

The driver supplies an `events` table (event_id, ts, user_id, ...), not
clinical files.  This adapter derives one measurement per event with a fixed
rule, so every registered query reads the given data and grows with it:

  study        STUDY00{1..3} from user and event_id / 6 (weight and height of
               one participant land in the same study)
  participant  P + user id, at least 4 digits          site   SITE_A..D from user id
  type         event_id mod 6 over the six types
  value        a number, a `sys/dia` pair for blood pressure, or `invalid`
  quality      0.80-1.00, NULL for some rows

`MEASUREMENTS_SQL` is the same derivation as ANSI SQL text for the DuckDB
oracles; `measurements()` is the DataFrame form Spark runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.functions.ids import measurement_id
from measures.functions.parsing import bp_part, value_num

_TYPES_BY_REMAINDER = ("glucose", "cholesterol", "weight", "height", "blood_pressure",
                       "heart_rate")
_UNITS_BY_REMAINDER = ("mg/dL", "mg/dL", "kg", "cm", "mmHg", "bpm")
_SITES_BY_REMAINDER = ("A", "B", "C", "D")

# Adapter as SQL text (the CTE `m`), valid in DuckDB and Spark SQL.
MEASUREMENTS_SQL = """
m AS (
SELECT event_id,
  concat('STUDY00', CAST((user_id + CAST(floor(event_id / 6) AS BIGINT) % 2) % 3 + 1 AS VARCHAR(10))) AS study_id,
  concat('P', lpad(CAST(user_id AS VARCHAR), CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS participant_id,
  concat('SITE_', CASE user_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END) AS site_id,
  CASE event_id % 6 WHEN 0 THEN 'glucose' WHEN 1 THEN 'cholesterol' WHEN 2 THEN 'weight'
       WHEN 3 THEN 'height' WHEN 4 THEN 'blood_pressure' ELSE 'heart_rate' END AS measurement_type,
  CASE WHEN event_id % 97 = 0 THEN 'invalid'
       WHEN event_id % 6 = 4 THEN concat(CAST(90 + event_id % 50 AS VARCHAR(10)), '/', CAST(60 + event_id % 30 AS VARCHAR(10)))
       ELSE concat(CAST(CASE event_id % 6 WHEN 3 THEN 150 ELSE 60 END + event_id % 40 AS VARCHAR(10)), '.', CAST(event_id % 10 AS VARCHAR(10))) END AS value,
  CASE event_id % 6 WHEN 2 THEN 'kg' WHEN 3 THEN 'cm' WHEN 4 THEN 'mmHg' WHEN 5 THEN 'bpm' ELSE 'mg/dL' END AS unit,
  ts AS "timestamp",
  CASE WHEN event_id % 53 = 0 THEN CAST(NULL AS DECIMAL(3,2))
       ELSE CAST((80 + event_id % 21) / 100.0 AS DECIMAL(3,2)) END AS quality_score
FROM events)
"""

# Stored (generated) columns and the id, in DuckDB syntax, over `m`.
FACTS_SQL = MEASUREMENTS_SQL + """,
facts AS (
SELECT
  substr(md5(h), 1, 8) || '-' || substr(md5(h), 9, 4) || '-' || substr(md5(h), 13, 4) || '-' ||
    substr(md5(h), 17, 4) || '-' || substr(md5(h), 21, 12) AS id,
  study_id, participant_id, site_id, measurement_type, value, unit, "timestamp", quality_score,
  CASE WHEN regexp_full_match(trim(value), '[0-9]+(\\.[0-9]+)?') THEN CAST(trim(value) AS DOUBLE) END AS value_num,
  CASE WHEN regexp_full_match(trim(value), '[0-9]+/[0-9]+') THEN CAST(split_part(trim(value), '/', 1) AS INTEGER) END AS bp_systolic,
  CASE WHEN regexp_full_match(trim(value), '[0-9]+/[0-9]+') THEN CAST(split_part(trim(value), '/', 2) AS INTEGER) END AS bp_diastolic,
  event_id
FROM (
  SELECT *, concat_ws('|', study_id, participant_id,
      strftime("timestamp", '%Y-%m-%d %H:%M:%S')
        || CASE WHEN date_trunc('second', "timestamp") <> "timestamp"
                THEN '.' || lpad(CAST(epoch_us("timestamp") % 1000000 AS VARCHAR), 6, '0') ELSE '' END
        || '+00:00',
      measurement_type, value) AS h
  FROM m) t)
"""


def _pick(index, values):
    expr = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        expr = F.when(index == i, F.lit(values[i])).otherwise(expr)
    return expr


def _padded(text, width: int):
    """At least `width` characters; longer text stays whole."""
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def measurements(events: DataFrame) -> DataFrame:
    """Raw measurement rows (as a landing file would carry them, typed)."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    kind = eid % 6
    study_no = (uid + F.floor(eid / 6) % 2) % 3 + 1
    numeric_value = F.concat(
        (F.when(kind == 3, F.lit(150)).otherwise(F.lit(60)) + eid % 40).cast("string"),
        F.lit("."), (eid % 10).cast("string"))
    bp_value = F.concat((90 + eid % 50).cast("string"), F.lit("/"), (60 + eid % 30).cast("string"))
    return events.select(
        eid.alias("event_id"),
        F.concat(F.lit("STUDY00"), study_no.cast("string")).alias("study_id"),
        F.concat(F.lit("P"), _padded(uid.cast("string"), 4)).alias("participant_id"),
        F.concat(F.lit("SITE_"), _pick(uid % 4, _SITES_BY_REMAINDER)).alias("site_id"),
        _pick(kind, _TYPES_BY_REMAINDER).alias("measurement_type"),
        F.when(eid % 97 == 0, F.lit("invalid"))
         .when(kind == 4, bp_value)
         .otherwise(numeric_value).alias("value"),
        _pick(kind, _UNITS_BY_REMAINDER).alias("unit"),
        F.col("ts").alias("timestamp"),
        F.when(eid % 53 == 0, F.lit(None).cast("decimal(3,2)"))
         .otherwise(((80 + eid % 21) / 100.0).cast("decimal(3,2)")).alias("quality_score"),
    )


def with_derived(df: DataFrame) -> DataFrame:
    """Add the stored derived columns and the deterministic id."""
    return df.select(
        measurement_id().alias("id"), *[c for c in df.columns],
        value_num("value").alias("value_num"),
        bp_part("value", 1).alias("bp_systolic"),
        bp_part("value", 2).alias("bp_diastolic"),
    )


def facts(events: DataFrame) -> DataFrame:
    """Measurements with id, value_num and blood-pressure parts, as stored."""
    return with_derived(measurements(events))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def facts_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(read_events(spark, sf_dir))
