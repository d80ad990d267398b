"""Table schemas and fixed values of the clinical-measurement model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Allowed measurement types, in the order the reference declares them.
VALID_MEASUREMENT_TYPES = ("glucose", "cholesterol", "weight", "height",
                           "blood_pressure", "heart_rate")
# Declared (and in the reference disabled) plausibility ranges, inclusive.
RANGE_LIMITS = {
    "glucose": (70, 200),
    "cholesterol": (100, 300),
    "weight": (30, 200),
    "height": (100, 250),
    "blood_pressure": (90, 120),
    "heart_rate": (60, 100),
}
# A reading is low quality when its stored quality score is below this.
LOW_QUALITY_THRESHOLD = Decimal("0.95")
# Columns a landing file must carry.
REQUIRED_COLUMNS = ("study_id", "participant_id", "measurement_type", "value", "timestamp")
# Columns the loader reads besides the required ones.
LOADED_COLUMNS = ("study_id", "participant_id", "measurement_type", "value", "unit",
                  "timestamp", "site_id", "quality_score")
# Optional columns: a file may carry its own row ids (used instead of the hash).
OPTIONAL_COLUMNS = ("id",)
# String columns whose surrounding whitespace is stripped.
STRIPPED_COLUMNS = ("study_id", "participant_id", "measurement_type", "unit", "site_id")
# Column length limits of the stored tables (VARCHAR(n)).
VARCHAR_LIMITS = {"study_id": 50, "participant_id": 50, "site_id": 50,
                  "measurement_type": 50, "unit": 20}
NOT_NULL_COLUMNS = ("study_id", "participant_id", "site_id", "measurement_type", "value",
                    "timestamp")
# Job progress per finished stage, and the job messages.
PROGRESS = {"started": 0, "extracted": 10, "transformed": 30, "validated": 50,
            "loaded": 90, "completed": 100}
MSG_STARTED = "Job started"
MSG_TRANSFORMED = "Data transformed"
MSG_VALIDATED = "Validation passed"
MSG_LOADED = "Loaded into DB"
MSG_COMPLETED = "Job completed successfully"
# Tokens read as missing in a landing file (the CSV reader's default set of
# the reference's toolkit).
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                  "nan", "null")
# ---------------------------------------------------------------------------

ROLLUP_KEYS = ("agg_day", "study_id", "site_id", "participant_id", "measurement_type")

FACT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("study_id", T.StringType(), False),
    T.StructField("participant_id", T.StringType(), False),
    T.StructField("site_id", T.StringType(), False),
    T.StructField("measurement_type", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
    T.StructField("unit", T.StringType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("quality_score", T.DecimalType(3, 2), True),
    T.StructField("processed_at", T.TimestampNTZType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("value_num", T.DoubleType(), True),
    T.StructField("bp_systolic", T.IntegerType(), True),
    T.StructField("bp_diastolic", T.IntegerType(), True),
    T.StructField("job_id", T.StringType(), True),
])

ROLLUP_SCHEMA = T.StructType([
    T.StructField("agg_day", T.DateType(), False),
    T.StructField("study_id", T.StringType(), False),
    T.StructField("site_id", T.StringType(), False),
    T.StructField("participant_id", T.StringType(), False),
    T.StructField("measurement_type", T.StringType(), False),
    T.StructField("measurement_count", T.LongType(), False),
    T.StructField("avg_value", T.DoubleType(), True),
    T.StructField("min_value", T.DoubleType(), True),
    T.StructField("max_value", T.DoubleType(), True),
    T.StructField("avg_systolic", T.DoubleType(), True),
    T.StructField("avg_diastolic", T.DoubleType(), True),
    T.StructField("avg_quality_score", T.DoubleType(), True),
    T.StructField("low_quality_count", T.LongType(), True),
])

ENROLLMENT_SCHEMA = T.StructType([
    T.StructField("participant_id", T.StringType(), False),
    T.StructField("study_id", T.StringType(), False),
    T.StructField("enrolled_at", T.TimestampNTZType(), False),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("filename", T.StringType(), True),
    T.StructField("study_id", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("progress", T.IntegerType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("event_at", T.TimestampNTZType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("load_id", T.StringType(), True),
])
