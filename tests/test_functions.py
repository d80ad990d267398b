"""Column expressions: one case per parsing trap (T2-T8, T17, T18, T21) and the id."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from measures.functions import (bp_overflow, bp_part, clamp_quality, is_low_quality,
                                measurement_id, null_if_missing, parse_timestamp_utc, strip_ws,
                                to_api_rows, value_num)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_quality_clamp_and_nulls(spark):
    got = one_col(spark, [None, "abc", "NaN", "1.7", "-2", "0.949", "0.98", " 0.5 "], clamp_quality)
    assert got == [None, None, None, Decimal("1.00"), Decimal("0.00"), Decimal("0.95"),
                   Decimal("0.98"), Decimal("0.50")]


def test_low_quality_after_decimal_rounding(spark):
    got = one_col(spark, ["0.949", "0.94", "0.95", None],
                  lambda c: is_low_quality(clamp_quality(c)))
    assert got == [False, True, False, None]


def test_timestamp_offsets_and_basic_forms(spark):
    got = one_col(spark, ["2024-01-15T09:30:00+02:00", "2024-01-15T09:30:00Z",
                          "2024-01-15 09:30:00", "20240115T093000Z", "2024-01-15",
                          "15/01/2024", None, "2024-01-15T09:30Z", "2024-01-15T09:30:00,5Z",
                          "2024-01-15T09:30:00.123456789Z", "2024-01-15T11+02:00"],
                  parse_timestamp_utc)
    assert got[0] == dt.datetime(2024, 1, 15, 7, 30)
    assert got[1] == dt.datetime(2024, 1, 15, 9, 30)
    assert got[2] == dt.datetime(2024, 1, 15, 9, 30)
    assert got[3] == dt.datetime(2024, 1, 15, 9, 30)
    assert got[4] == dt.datetime(2024, 1, 15, 0, 0)
    assert got[5] is None and got[6] is None
    assert got[7] == dt.datetime(2024, 1, 15, 9, 30)
    assert got[8] == dt.datetime(2024, 1, 15, 9, 30, 0, 500000)
    assert got[9] == dt.datetime(2024, 1, 15, 9, 30, 0, 123456)
    assert got[10] == dt.datetime(2024, 1, 15, 9, 0)


def test_strip_all_whitespace(spark):
    assert one_col(spark, ["  SITE_A\t", "\nP001 "], strip_ws) == ["SITE_A", "P001"]


def test_value_num_pattern(spark):
    got = one_col(spark, [" 180 ", "95.5", "-5", "1e3", ".5", "5.", "invalid", "95.5\n", "120/80"],
                  value_num)
    assert got == [180.0, 95.5, None, None, None, None, None, None, None]


def test_blood_pressure_parts_and_overflow(spark):
    df = spark.createDataFrame([("120/80",), (" 130/85 ",), ("99999999999/80",), ("72",)],
                               "v string")
    rows = df.select(bp_part("v", 1), bp_part("v", 2), bp_overflow("v")).collect()
    assert [tuple(r) for r in rows] == [(120, 80, False), (130, 85, False), (None, 80, True),
                                        (None, None, False)]


def test_missing_tokens(spark):
    got = one_col(spark, ["", "NA", "n/a", "null", "None", "NaN", "x", " NA"], null_if_missing)
    assert got == [None] * 6 + ["x", " NA"]


def test_published_ids(spark):
    rows = [("STUDY001", "P003", dt.datetime(2024, 1, 15, 11, 0), "glucose", "88.2"),
            ("STUDY001", "P002", dt.datetime(2024, 1, 15, 10, 15), "glucose", "102.1"),
            ("STUDY001", "P001", dt.datetime(2024, 1, 15, 9, 30), "glucose", "95.5"),
            ("STUDY002", "P001", dt.datetime(2024, 1, 16, 9, 0), "blood_pressure", "120/80"),
            ("STUDY002", "P001", dt.datetime(2024, 1, 16, 9, 0), "heart_rate", "72"),
            ("STUDY001", "P001", dt.datetime(2024, 1, 15, 9, 30), "cholesterol", "180")]
    df = spark.createDataFrame(rows, "study_id string, participant_id string, "
                                     "timestamp timestamp_ntz, measurement_type string, value string")
    ids = [r[0] for r in df.select(measurement_id()).collect()]
    assert ids == ["9ca1d38b-3d8f-4916-8368-402ea20bb85c",
                   "a7bafe00-7016-aa63-a48e-a8bcb1c79d6f",
                   "b5040dff-6f05-38d5-08ee-83a83cc26a9d",
                   "52713291-c869-548a-9f90-9ec892506523",
                   "d9f8376a-bb49-3e9a-5a13-f3978e7ec89c",
                   "10c11717-54a3-5c92-d834-2458334e7eb9"]


def test_id_fractional_seconds(spark):
    import hashlib
    import uuid
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([("S", "P", ts, "glucose", "1.0")],
                               "study_id string, participant_id string, timestamp timestamp_ntz, "
                               "measurement_type string, value string")
    key = "S|P|2024-01-01 00:00:07.179575+00:00|glucose|1.0"
    expected = str(uuid.UUID(hashlib.md5(key.encode()).hexdigest()))
    assert df.select(measurement_id()).first()[0] == expected


def test_api_layout(spark):
    df = spark.createDataFrame(
        [("id1", "STUDY001", "P001", "glucose", "95.5", "mg/dL", dt.datetime(2024, 1, 15, 9, 30),
          "SITE_A", Decimal("0.98"))],
        "id string, study_id string, participant_id string, measurement_type string, "
        "value string, unit string, timestamp timestamp_ntz, site_id string, "
        "quality_score decimal(3,2)")
    row = to_api_rows(df).first().asDict()
    assert row == {"id": "id1", "studyId": "STUDY001", "participantId": "P001",
                   "measurementType": "glucose", "value": "95.5", "unit": "mg/dL",
                   "timestamp": "2024-01-15T09:30:00.000Z", "siteId": "SITE_A",
                   "qualityScore": "0.98"}


def test_id_depends_on_five_fields_only(spark):
    base = ("STUDY001", "P001", dt.datetime(2024, 1, 15, 9, 30), "glucose", "95.5")
    rows = [(*base, "SITE_A", "mg/dL", Decimal("0.98")),
            (*base, "SITE_B", "mmol/L", None),
            ("STUDY001", "P001", dt.datetime(2024, 1, 15, 9, 30), "glucose", "95.50", "SITE_A",
             "mg/dL", Decimal("0.98"))]
    df = spark.createDataFrame(rows, "study_id string, participant_id string, "
                                     "timestamp timestamp_ntz, measurement_type string, "
                                     "value string, site_id string, unit string, "
                                     "quality_score decimal(3,2)")
    ids = [r[0] for r in df.select(measurement_id()).collect()]
    assert ids[0] == ids[1] == "b5040dff-6f05-38d5-08ee-83a83cc26a9d"
    assert ids[2] != ids[0]  # the raw value text takes part


def test_offsets_survive_an_ntz_default_session(spark):
    from measures.session import ensure_session
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    try:
        ensure_session(spark)
        got = one_col(spark, ["2024-01-15T09:30:00+02:00"], parse_timestamp_utc)
        assert got == [dt.datetime(2024, 1, 15, 7, 30)]
    finally:
        spark.conf.set("spark.sql.timestampType", "TIMESTAMP_LTZ")


def test_iso_8601_forms(spark):
    from measures.functions.parsing import parse_timestamp_utc
    good = {"2024": dt.datetime(2024, 1, 1), "2024-02": dt.datetime(2024, 2, 1),
            "20240215": dt.datetime(2024, 2, 15), "2024015": dt.datetime(2024, 1, 15),
            "2024-366": dt.datetime(2024, 12, 31), "2024-W03": dt.datetime(2024, 1, 15),
            "2024W037T0930Z": dt.datetime(2024, 1, 21, 9, 30),
            "2020-W53-5": dt.datetime(2021, 1, 1),
            "2024-01-15T24:00": dt.datetime(2024, 1, 16),
            "2024-01-15T09:30:00,5+02:00": dt.datetime(2024, 1, 15, 7, 30, 0, 500000),
            "2024-01-15 09:30:00.123456789": dt.datetime(2024, 1, 15, 9, 30, 0, 123456),
            "20240115T093000-0530": dt.datetime(2024, 1, 15, 15, 0),
            "2024-01-15T09+01": dt.datetime(2024, 1, 15, 8),
            "2024-01-15T09:30:00Z": dt.datetime(2024, 1, 15, 9, 30)}
    assert one_col(spark, list(good), parse_timestamp_utc) == list(good.values())
    bad = ["09:30:00", "202401", "2024-1-5", "2024-01-15T09:30:00 Europe/Paris", "2024-13-01",
           "2024-02-30", "2024-01-15T24:01", "2024-01-15T09:60", "2023-366", "2024-W54", "", None]
    assert one_col(spark, bad, parse_timestamp_utc) == [None] * len(bad)


def test_quality_takes_plain_numbers_only(spark):
    got = one_col(spark, ["0.9d", "0.9f", "0x1p-1", "9e-1", "+.5", "1_0"], clamp_quality)
    assert [None if x is None else str(x) for x in got] == [None, None, None, "0.90", "0.50", None]


def test_adapter_keeps_long_user_ids_apart(spark):
    import duckdb
    from measures.sources import adapter
    ids = [7, 1234, 12345, 12346, 123450]
    events = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), u, 1.0) for i, u in enumerate(ids)],
        "event_id bigint, ts timestamp_ntz, user_id bigint, value double")
    want = ["P0007", "P1234", "P12345", "P12346", "P123450"]
    assert [r[0] for r in adapter.measurements(events).orderBy("event_id")
            .select("participant_id").collect()] == want
    con = duckdb.connect()
    con.sql("CREATE TABLE events AS SELECT i AS event_id, TIMESTAMP '2024-01-01' AS ts, "
            f"({ids})[i + 1]::BIGINT AS user_id, 1.0 AS value FROM range({len(ids)}) t(i)")
    assert [r[0] for r in con.sql(f"WITH {adapter.MEASUREMENTS_SQL} SELECT participant_id "
                                  "FROM m ORDER BY event_id").fetchall()] == want
