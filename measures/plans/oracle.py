"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every statement reads the driver's `events` view through the adapter CTEs
(`m`, `facts`) and recomputes the answer in plain SQL, independently of the
Spark code path.
"""

from __future__ import annotations

from measures.plans import dirty, scenarios
from measures.plans.params import (AM_SPLIT_HOUR, BMI_STUDY, FIRST_LOAD_END, LOOKUP_JOB,
                                   LOAD_INSTANT, READ_FILTERS, RECENT_AS_OF, RECENT_DAYS, STUDY_READ,
                                   TREND_PARTICIPANT, TREND_TYPE)
from measures.schema import RANGE_LIMITS
from measures.sources.adapter import FACTS_SQL

MEASURES = ("measurement_count", "avg_value", "min_value", "max_value", "avg_systolic",
            "avg_diastolic", "avg_quality_score", "low_quality_count")
KEYS = ("agg_day", "study_id", "site_id", "participant_id", "measurement_type")


def rollup_cte(name: str, source: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT CAST("timestamp" AS DATE) AS agg_day, study_id, site_id, participant_id, measurement_type,
    COUNT(*) AS measurement_count,
    AVG(value_num) AS avg_value, MIN(value_num) AS min_value, MAX(value_num) AS max_value,
    AVG(bp_systolic) AS avg_systolic, AVG(bp_diastolic) AS avg_diastolic,
    AVG(CAST(quality_score AS DOUBLE)) AS avg_quality_score,
    CAST(SUM(CAST(quality_score < 0.95 AS INTEGER)) AS BIGINT) AS low_quality_count
  FROM {source} WHERE {where}
  GROUP BY 1, 2, 3, 4, 5)"""


def with_facts(*ctes: str) -> str:
    return "WITH " + FACTS_SQL + "".join(",\n" + c for c in ctes) + "\n"


def r6(expr: str) -> str:
    return f"ROUND({expr}, 6)"


def rollup_select(alias: str = "") -> str:
    p = alias + "." if alias else ""
    cols = [f"{p}{k}" for k in KEYS] + [f"{p}measurement_count"]
    cols += [f"{r6(p + m)} AS {m}" for m in MEASURES[1:7]] + [f"{p}low_quality_count"]
    return ", ".join(cols)


FAITHFUL_MERGE_SELECT = """
SELECT {keys},
  CASE WHEN o.measurement_count IS NOT NULL AND n.measurement_count IS NOT NULL
       THEN o.measurement_count + n.measurement_count
       ELSE COALESCE(o.measurement_count, n.measurement_count) END AS measurement_count,
  {avg_value} AS avg_value,
  {min_value} AS min_value,
  {max_value} AS max_value,
  {avg_systolic} AS avg_systolic,
  {avg_diastolic} AS avg_diastolic,
  {avg_quality_score} AS avg_quality_score,
  {low_quality_count} AS low_quality_count
FROM o FULL OUTER JOIN n ON {on}
"""


def faithful_merge_sql(rounded: bool = True) -> str:
    both = "o.measurement_count IS NOT NULL AND n.measurement_count IS NOT NULL"
    only_old = "o.measurement_count IS NOT NULL"
    total = "(o.measurement_count + n.measurement_count)"

    def case(merged: str, m: str, rnd: bool = True) -> str:
        e = f"CASE WHEN {both} THEN {merged} WHEN {only_old} THEN o.{m} ELSE n.{m} END"
        return r6(e) if rnd and rounded else e

    def weighted(m: str, denom: str = total) -> str:
        return f"(o.{m} * o.measurement_count + n.{m} * n.measurement_count) / {denom}"

    return FAITHFUL_MERGE_SELECT.format(
        keys=", ".join(f"COALESCE(o.{k}, n.{k}) AS {k}" for k in KEYS),
        avg_value=case(weighted("avg_value"), "avg_value"),
        min_value=case("LEAST(o.min_value, n.min_value)", "min_value"),
        max_value=case("GREATEST(o.max_value, n.max_value)", "max_value"),
        avg_systolic=case(f"COALESCE({weighted('avg_systolic', f'NULLIF({total}, 0)')}, o.avg_systolic)",
                          "avg_systolic"),
        avg_diastolic=case(f"COALESCE({weighted('avg_diastolic', f'NULLIF({total}, 0)')}, o.avg_diastolic)",
                           "avg_diastolic"),
        avg_quality_score=case(weighted("avg_quality_score"), "avg_quality_score"),
        low_quality_count=case("o.low_quality_count + n.low_quality_count", "low_quality_count",
                               rnd=False),
        on=" AND ".join(f"o.{k} = n.{k}" for k in KEYS),
    )


# --- The registered queries' SQL twins ------------------------------------------
_FACT_COLS = ("id, study_id, participant_id, site_id, measurement_type, value, unit, "
              "\"timestamp\", quality_score, value_num, bp_systolic, bp_diastolic")
_READER_COLS = ("id, study_id, participant_id, measurement_type, value, unit, \"timestamp\", "
                "site_id, quality_score")
_ROLLUP = rollup_cte("rollup", "facts")
_AM = f'hour("timestamp") < {AM_SPLIT_HOUR}'
_PM = f'hour("timestamp") >= {AM_SPLIT_HOUR}'
_LATEST_W = """
SELECT participant_id, measurement_type, v FROM (
  SELECT participant_id, measurement_type, value_num AS v,
    row_number() OVER (PARTITION BY participant_id, measurement_type
                       ORDER BY "timestamp" DESC, id DESC) AS rn
  FROM facts WHERE study_id = '{study}' AND measurement_type IN ('weight', 'height')) t
WHERE rn = 1"""
_READ_WHERE = (f"study_id = '{READ_FILTERS['study_id']}' AND measurement_type = "
               f"'{READ_FILTERS['measurement_type']}' AND \"timestamp\" >= TIMESTAMP "
               f"'{READ_FILTERS['start_date']}' AND \"timestamp\" <= TIMESTAMP "
               f"'{READ_FILTERS['end_date']}'")

def _q7_rollup_sql(ctes: list[str], table: str) -> str:
    """Each participant's last weight and height by one grouping, as the
    operator takes them."""
    def last(kind: str) -> str:
        return (f"arg_max_null(avg_value, row(agg_day, site_id)) "
                f"FILTER (measurement_type = '{kind}')")
    return with_facts(*ctes) + f"""SELECT ROUND(AVG(kg / POWER(cm / 100, 2)), 2) AS avg_bmi
FROM (SELECT {last('weight')} AS kg, {last('height')} AS cm FROM {table}
      WHERE study_id = '{BMI_STUDY}' GROUP BY participant_id)"""


ORACLES: dict[str, str] = {
    "facts": with_facts() + f"SELECT {_FACT_COLS} FROM facts",
    "daily_rollup": with_facts(_ROLLUP) + f"SELECT {rollup_select()} FROM rollup",
    "rollup_merge_faithful": with_facts(rollup_cte("o", "facts", _AM), rollup_cte("n", "facts", _PM))
    + faithful_merge_sql(),
    "rollup_merge_exact": with_facts(_ROLLUP) + f"SELECT {rollup_select()} FROM rollup",
    "enrollments": with_facts() + 'SELECT participant_id, study_id, MIN("timestamp") AS enrolled_at '
    "FROM facts GROUP BY participant_id, study_id",
    "new_participants": with_facts() + "SELECT DISTINCT participant_id FROM facts WHERE "
    f"\"timestamp\" >= TIMESTAMP '{FIRST_LOAD_END}' AND participant_id NOT IN "
    f"(SELECT participant_id FROM facts WHERE \"timestamp\" < TIMESTAMP '{FIRST_LOAD_END}')",
    "q1_quality_by_study": with_facts()
    + "SELECT study_id, CAST(ROUND(SUM(quality_score) / COUNT(quality_score), 3) AS DOUBLE) AS avg_qs, "
    "COUNT(*) AS rows FROM facts GROUP BY study_id ORDER BY avg_qs DESC",
    "q1_quality_by_study_rollup": with_facts(_ROLLUP)
    + f"SELECT study_id, {r6('AVG(avg_quality_score)')} AS avg_qs, COUNT(*) AS rows FROM rollup "
    "GROUP BY study_id ORDER BY avg_qs DESC",
    "q2_trend": with_facts()
    + f"SELECT CAST(\"timestamp\" AS DATE) AS day, {r6('AVG(value_num)')} AS avg_glucose_mg_dl "
    f"FROM facts WHERE participant_id = '{TREND_PARTICIPANT}' AND measurement_type = '{TREND_TYPE}' "
    "GROUP BY 1 ORDER BY 1",
    "q2_trend_rollup": with_facts(_ROLLUP)
    + f"SELECT agg_day AS day, {r6('SUM(avg_value * measurement_count) / SUM(measurement_count)')} "
    f"AS avg_glucose_mg_dl FROM rollup WHERE participant_id = '{TREND_PARTICIPANT}' "
    f"AND measurement_type = '{TREND_TYPE}' GROUP BY agg_day ORDER BY agg_day",
    "q3_counts_by_site": with_facts()
    + "SELECT site_id, COUNT(*) AS measurement_count FROM facts GROUP BY site_id ORDER BY 2 DESC",
    "q3_counts_by_site_rollup": with_facts(_ROLLUP)
    + "SELECT site_id, CAST(SUM(measurement_count) AS BIGINT) AS measurement_count FROM rollup "
    "GROUP BY site_id ORDER BY 2 DESC",
    "q4_low_quality": with_facts(_ROLLUP)
    + f"SELECT {rollup_select()} FROM rollup WHERE low_quality_count > 0 "
    "ORDER BY agg_day, study_id, participant_id",
    "q5_recent": with_facts()
    + f"SELECT {_FACT_COLS} FROM facts WHERE \"timestamp\" >= "
    f"CAST(DATE '{RECENT_AS_OF.isoformat()}' - INTERVAL {RECENT_DAYS} DAY AS TIMESTAMP) "
    "ORDER BY \"timestamp\"",
    "q6_participants": with_facts()
    + "SELECT study_id, COUNT(*) AS participants FROM (SELECT DISTINCT participant_id, study_id "
    "FROM facts) e GROUP BY study_id ORDER BY participants DESC",
    "q7_mean_bmi": with_facts(f"latest AS ({_LATEST_W.format(study=BMI_STUDY)})")
    + "SELECT ROUND(AVG(w.v / POWER(h.v / 100, 2)), 2) AS avg_bmi "
    "FROM (SELECT * FROM latest WHERE measurement_type = 'weight') w "
    "JOIN (SELECT * FROM latest WHERE measurement_type = 'height') h USING (participant_id)",
    "q7_mean_bmi_rollup": None,  # filled below from _q7_rollup_sql
    "r1_measurements": with_facts()
    + f"SELECT {_READER_COLS} FROM facts WHERE {_READ_WHERE} "
    "ORDER BY \"timestamp\" DESC, id LIMIT 1000",
    "r1_measurements_api": with_facts()
    + "SELECT id, study_id AS studyId, participant_id AS participantId, "
    "measurement_type AS measurementType, value, unit, "
    "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS \"timestamp\", site_id AS siteId, "
    f"CAST(quality_score AS VARCHAR) AS qualityScore FROM facts WHERE {_READ_WHERE} "
    "ORDER BY facts.\"timestamp\" DESC, id LIMIT 1000",
    "r2_study": with_facts()
    + f"SELECT {_READER_COLS} FROM facts WHERE study_id = '{STUDY_READ}' "
    "ORDER BY \"timestamp\" DESC, id LIMIT 1000",
}

ORACLES["q7_mean_bmi_rollup"] = _q7_rollup_sql([_ROLLUP], "rollup")

_UUID = ("substr(md5({x}), 1, 8) || '-' || substr(md5({x}), 9, 4) || '-' || substr(md5({x}), 13, 4)"
         " || '-' || substr(md5({x}), 17, 4) || '-' || substr(md5({x}), 21, 12)")
_JOB_NAME = ("concat_ws('_', study_id, CAST(CAST(\"timestamp\" AS DATE) AS VARCHAR), "
             f"CASE WHEN hour(\"timestamp\") < {AM_SPLIT_HOUR} THEN 'am' ELSE 'pm' END)")
_JOBS = ("jobs AS (SELECT DISTINCT " + _UUID.format(x=_JOB_NAME) + " AS job_id, "
         + _UUID.format(x=_JOB_NAME) + " || '_' || " + _JOB_NAME + " AS filename, study_id, "
         + _JOB_NAME + " AS job_name FROM facts)")
_RANGE_LIMITS_SQL = ("limits(measurement_type, low, high) AS (VALUES "
                     + ", ".join(f"('{t}', {float(lo)}, {float(hi)})"
                                 for t, (lo, hi) in RANGE_LIMITS.items()) + ")")

ORACLES.update({
    "etl_facts": with_facts() + f"SELECT {_FACT_COLS}, "
    + _UUID.format(x=_JOB_NAME) + " AS job_id FROM facts",
    "etl_rollup": ORACLES["rollup_merge_faithful"],
    "etl_rollup_exact": ORACLES["daily_rollup"],
    "etl_enrollments": ORACLES["enrollments"],
    "etl_jobs": with_facts(_JOBS) + "SELECT job_id, filename, 'completed' AS status, "
    "100 AS progress, 'Job completed successfully' AS message, "
    "CAST(NULL AS VARCHAR) AS error_message FROM jobs",
    "etl_job_lookup": with_facts(_JOBS) + "SELECT job_id AS id, filename, "
    "CAST(NULL AS VARCHAR) AS study_id, 'completed' AS status, "
    f"CAST(NULL AS VARCHAR) AS error_message FROM jobs WHERE job_name = '{LOOKUP_JOB}'",
    "etl_job_status": with_facts(_JOBS) + "SELECT job_id, 'completed' AS status, "
    "100 AS progress, 'Job completed successfully' AS message FROM jobs",
    "fk_orphans": with_facts(
        "studies AS (SELECT DISTINCT study_id FROM facts)",
        "sites AS (SELECT DISTINCT site_id FROM facts)",
        "enrolled AS (SELECT DISTINCT participant_id, study_id FROM facts)")
    + "SELECT 'measurement.study_id -> studies' AS \"constraint\", COUNT(*) AS orphan_rows "
    "FROM facts WHERE study_id NOT IN (SELECT study_id FROM studies) UNION ALL "
    "SELECT 'measurement.site_id -> sites', COUNT(*) FROM facts "
    "WHERE site_id NOT IN (SELECT site_id FROM sites) UNION ALL "
    "SELECT 'measurement.(participant_id, study_id) -> enrollments', COUNT(*) FROM facts f "
    "WHERE NOT EXISTS (SELECT 1 FROM enrolled e WHERE e.participant_id = f.participant_id "
    "AND e.study_id = f.study_id) UNION ALL "
    "SELECT 'enrollment.participant_id -> participants', COUNT(*) FROM enrolled "
    "WHERE participant_id NOT IN (SELECT participant_id FROM facts) UNION ALL "
    "SELECT 'enrollment.study_id -> studies', COUNT(*) FROM enrolled "
    "WHERE study_id NOT IN (SELECT study_id FROM studies)",
    "range_report": with_facts(_RANGE_LIMITS_SQL) + "SELECT f.measurement_type, "
    "COUNT(r) AS readings, CAST(SUM(CAST(r < low AS BIGINT)) AS BIGINT) AS below_range, "
    "CAST(SUM(CAST(r > high AS BIGINT)) AS BIGINT) AS above_range FROM (SELECT measurement_type, "
    "CASE WHEN measurement_type = 'blood_pressure' THEN CAST(bp_systolic AS DOUBLE) "
    "ELSE value_num END AS r FROM facts) f JOIN limits USING (measurement_type) "
    "GROUP BY f.measurement_type",
})

# Roll-up as stored after the morning and the afternoon load (faithful merge).
_MERGED = ("merged AS (" + faithful_merge_sql(rounded=False) + ")")
_STORED_ROLLUP = [rollup_cte("o", "facts", _AM), rollup_cte("n", "facts", _PM), _MERGED]


def _merged_oracle(name: str) -> str:
    """An oracle written over `rollup`, re-pointed at the two-load roll-up."""
    tail = ORACLES[name][len(with_facts(_ROLLUP)):]
    return with_facts(*_STORED_ROLLUP) + tail.replace("FROM rollup", "FROM merged")


ORACLES.update({
    "stream_ingest_facts": ORACLES["etl_facts"],
    "stream_daily_rollup": with_facts(_ROLLUP) + f"SELECT {rollup_select()} FROM rollup "
    "WHERE CAST(agg_day + INTERVAL 1 DAY AS TIMESTAMP) <= "
    "(SELECT MAX(\"timestamp\") FROM facts) - INTERVAL 1 DAY",
    "stored_q1_quality_by_study": ORACLES["q1_quality_by_study"],
    "stored_q1_quality_by_study_rollup": _merged_oracle("q1_quality_by_study_rollup"),
    "stored_q2_trend_rollup": _merged_oracle("q2_trend_rollup"),
    "stored_q3_counts_by_site_rollup": _merged_oracle("q3_counts_by_site_rollup"),
    "stored_q4_low_quality": _merged_oracle("q4_low_quality"),
    "stored_q5_recent": ORACLES["q5_recent"],
    "stored_q6_participants": ORACLES["q6_participants"],
    "stored_q7_mean_bmi": ORACLES["q7_mean_bmi"],
    "stored_q7_mean_bmi_rollup": _q7_rollup_sql(_STORED_ROLLUP, "merged"),
    "stored_r1_measurements": f"SELECT *, TIMESTAMP '{LOAD_INSTANT}' AS processed_at "
    f"FROM ({ORACLES['r1_measurements']})",
    "stored_r2_study": f"SELECT *, TIMESTAMP '{LOAD_INSTANT}' AS processed_at "
    f"FROM ({ORACLES['r2_study']})",
    "sql_q1_quality_by_study": ORACLES["q1_quality_by_study"],
    "sql_q1_quality_by_study_rollup": _merged_oracle("q1_quality_by_study_rollup"),
    "sql_q2_trend": ORACLES["q2_trend"],
    "sql_q2_trend_rollup": _merged_oracle("q2_trend_rollup"),
    "sql_q3_counts_by_site": ORACLES["q3_counts_by_site"],
    "sql_q3_counts_by_site_rollup": _merged_oracle("q3_counts_by_site_rollup"),
    "sql_q4_low_quality": _merged_oracle("q4_low_quality"),
    "sql_q5_recent": ORACLES["q5_recent"],
    "sql_q6_participants": ORACLES["q6_participants"],
    "sql_q7_mean_bmi": ORACLES["q7_mean_bmi"],
    "sql_q7_mean_bmi_rollup": _q7_rollup_sql(_STORED_ROLLUP, "merged"),
})

ORACLES.update(dirty.oracles(with_facts, _FACT_COLS, ORACLES["daily_rollup"]))
ORACLES.update(scenarios.oracles(with_facts, _FACT_COLS, ORACLES["daily_rollup"],
                                 ORACLES["q1_quality_by_study"]))
ORACLES["j1_latest_weight_height"] = with_facts(f"""latest AS (
  SELECT participant_id, measurement_type, value_num AS v FROM facts
  WHERE study_id = '{BMI_STUDY}' AND measurement_type IN ('weight', 'height')
  QUALIFY row_number() OVER (PARTITION BY participant_id, measurement_type
                             ORDER BY "timestamp" DESC, id DESC) = 1)""") + """
SELECT w.participant_id, round(w.v, 6) AS weight_kg, round(h.v, 6) AS height_cm
FROM latest w JOIN latest h USING (participant_id)
WHERE w.measurement_type = 'weight' AND h.measurement_type = 'height'"""
