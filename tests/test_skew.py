"""A hot key (one participant holding most of the rows): the roll-up,
the latest-value BMI and enrollments still equal a brute-force pandas
computation over the same rows."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from measures.operators import dimensions, rollup
from measures.plans import analytics
from measures.sources import adapter

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("driver tables not present")
    facts = adapter.facts_from_dir(spark, SF)
    # Participants whose id ends in 1-6 (about 60% of rows) become one key.
    hot = F.when(F.substring("participant_id", -1, 1).isin(*"123456"), F.lit("P_HOT")) \
        .otherwise(F.col("participant_id"))
    return facts.withColumn("participant_id", hot).drop("event_id")


def test_rollup_equals_pandas(spark, skewed):
    pdf = skewed.toPandas()
    pdf["agg_day"] = pd.to_datetime(pdf["timestamp"]).dt.date
    pdf["q"] = pdf["quality_score"].astype(float)
    pdf["low"] = (pdf["q"] < 0.95).where(pdf["q"].notna())
    keys = ["agg_day", "study_id", "site_id", "participant_id", "measurement_type"]
    want = pdf.groupby(keys, dropna=False).agg(
        measurement_count=("id", "size"), avg_value=("value_num", "mean"),
        max_value=("value_num", "max"), avg_systolic=("bp_systolic", "mean"),
        avg_quality_score=("q", "mean"), low=("low", "sum")).reset_index()
    got = rollup.daily_rollup(skewed).toPandas()
    m = want.merge(got, on=keys, suffixes=("_w", "_g"))
    assert len(m) == len(want) == len(got)
    assert (m["measurement_count_w"] == m["measurement_count_g"]).all()
    for c in ("avg_value", "max_value", "avg_systolic", "avg_quality_score"):
        both = m[[c + "_w", c + "_g"]].astype(float)
        same = ((both[c + "_w"] - both[c + "_g"]).abs() < 1e-9) | (
            both[c + "_w"].isna() & both[c + "_g"].isna())
        assert same.all(), c
    assert (got["participant_id"] == "P_HOT").sum() > 0


def test_latest_value_bmi_equals_pandas(spark, skewed):
    pdf = skewed.where("study_id = 'STUDY001'").toPandas()
    latest = {}
    for t in ("weight", "height"):
        sub = pdf[pdf["measurement_type"] == t].sort_values(["timestamp", "id"])
        latest[t] = sub.groupby("participant_id").tail(1).set_index("participant_id")["value_num"]
    both = pd.concat([latest["weight"].rename("w"), latest["height"].rename("h")], axis=1,
                     join="inner")
    assert len(both) > 0
    want = round((both["w"] / (both["h"] / 100) ** 2).mean(), 2)
    got = analytics.mean_bmi(skewed, "STUDY001").first()[0]
    assert got == pytest.approx(want, abs=0.006)


def test_enrollments_equal_pandas(spark, skewed):
    pdf = skewed.toPandas()
    want = pdf.groupby(["participant_id", "study_id"])["timestamp"].min()
    got = dimensions.first_seen(skewed).toPandas().set_index(
        ["participant_id", "study_id"])["enrolled_at"]
    assert (want.sort_index() == got.sort_index()).all()
