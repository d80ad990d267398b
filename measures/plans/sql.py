"""The analytic questions as Spark SQL over named views.

`register_views` exposes a store under the table names analysts already use
(clinical_measurements, measurement_aggregations, participant_enrollments,
studies, sites, participants, etl_jobs), so the questions can be asked in
SQL as well as through `analytics`.  Catalyst plans both forms the same way.
Spark SQL has no `DISTINCT ON`; "latest row per key" is `max_by` over a
struct of the ordering columns (last one breaks ties).  Literals of the
original statements are named parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from measures.operators import ledger
from measures.sources.store import Store


def register_views(spark: SparkSession, store: Store, prefix: str = "") -> None:
    """Temporary views over the store's tables (and the ledger's current state)."""
    store.measurements(spark).createOrReplaceTempView(prefix + "clinical_measurements")
    store.rollup(spark).createOrReplaceTempView(prefix + "measurement_aggregations")
    store.enrollments(spark).createOrReplaceTempView(prefix + "participant_enrollments")
    for table in ("studies", "sites", "participants"):
        store.read_or_empty(spark, table).createOrReplaceTempView(prefix + table)
    ledger.current_jobs(store.jobs(spark)).withColumnRenamed("job_id", "id") \
        .createOrReplaceTempView(prefix + "etl_jobs")


STATEMENTS: dict[str, str] = {
    # Q1 -- which studies have the highest data quality scores?
    "q1_raw": """
        SELECT study_id, CAST(ROUND(SUM(quality_score) / COUNT(quality_score), 3) AS DOUBLE) AS avg_qs,
               COUNT(*) AS rows
        FROM {p}clinical_measurements GROUP BY study_id ORDER BY avg_qs DESC""",
    "q1_rollup": """
        SELECT study_id, ROUND(AVG(avg_quality_score), :digits) AS avg_qs, COUNT(*) AS rows
        FROM {p}measurement_aggregations GROUP BY study_id ORDER BY avg_qs DESC""",
    # Q2 -- trend of one type for one participant
    "q2_raw": """
        SELECT CAST(DATE_TRUNC('day', `timestamp`) AS DATE) AS day,
               ROUND(AVG(value_num), :digits) AS avg_glucose_mg_dl
        FROM {p}clinical_measurements
        WHERE participant_id = :participant AND measurement_type = :mtype
        GROUP BY CAST(DATE_TRUNC('day', `timestamp`) AS DATE) ORDER BY day""",
    "q2_rollup": """
        SELECT agg_day AS day,
               ROUND(SUM(avg_value * measurement_count) / SUM(measurement_count), :digits)
                 AS avg_glucose_mg_dl
        FROM {p}measurement_aggregations
        WHERE participant_id = :participant AND measurement_type = :mtype
        GROUP BY agg_day ORDER BY agg_day""",
    # Q3 -- measurement counts per site
    "q3_raw": """
        SELECT site_id, COUNT(*) AS measurement_count FROM {p}clinical_measurements
        GROUP BY site_id ORDER BY measurement_count DESC""",
    "q3_rollup": """
        SELECT site_id, CAST(SUM(measurement_count) AS BIGINT) AS measurement_count
        FROM {p}measurement_aggregations GROUP BY site_id ORDER BY measurement_count DESC""",
    # Q4 -- buckets with readings below the quality threshold
    "q4": """
        SELECT * FROM {p}measurement_aggregations WHERE low_quality_count > 0
        ORDER BY agg_day, study_id, participant_id, site_id, measurement_type""",
    # Q5 -- data collected in the last :days days before :as_of
    "q5": """
        SELECT * FROM {p}clinical_measurements
        WHERE `timestamp` >= CAST(DATE_SUB(CAST(:as_of AS DATE), :days) AS TIMESTAMP_NTZ)
        ORDER BY `timestamp`, id""",
    # Q6 -- participants enrolled per study
    "q6": """
        SELECT study_id, COUNT(*) AS participants FROM {p}participant_enrollments
        GROUP BY study_id ORDER BY participants DESC""",
    # Q7 -- mean BMI in one study
    "q7_raw": """
        SELECT ROUND(AVG(kg / POWER(cm / 100, 2)), 2) AS avg_bmi
        FROM (SELECT MAX_BY(value_num, STRUCT(`timestamp`, id))
                       FILTER (WHERE measurement_type = 'weight') AS kg,
                     MAX_BY(value_num, STRUCT(`timestamp`, id))
                       FILTER (WHERE measurement_type = 'height') AS cm
              FROM {p}clinical_measurements
              WHERE study_id = :study AND measurement_type IN ('weight', 'height')
              GROUP BY participant_id)""",
    "q7_rollup": """
        SELECT ROUND(AVG(kg / POWER(cm / 100, 2)), 2) AS avg_bmi
        FROM (SELECT MAX_BY(avg_value, STRUCT(agg_day, site_id))
                       FILTER (WHERE measurement_type = 'weight') AS kg,
                     MAX_BY(avg_value, STRUCT(agg_day, site_id))
                       FILTER (WHERE measurement_type = 'height') AS cm
              FROM {p}measurement_aggregations
              WHERE study_id = :study AND measurement_type IN ('weight', 'height')
              GROUP BY participant_id)""",
}

DEFAULTS = {"digits": 6, "participant": "P001", "mtype": "glucose", "as_of": "2024-01-31",
            "days": 30, "study": "STUDY001"}


def run(spark: SparkSession, name: str, prefix: str = "", **params) -> DataFrame:
    """Run one statement with named parameters (defaults in DEFAULTS)."""
    text = STATEMENTS[name].format(p=prefix)
    args = {k: v for k, v in {**DEFAULTS, **params}.items() if f":{k}" in text}
    return spark.sql(text, args=args)
