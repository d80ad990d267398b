"""Staging for the ingestion stream is dealt over tasks."""

import pytest

from measures.plans import scenarios
from measures.plans.scenarios import Crash


def test_staging_two_files_a_job_is_not_one_task(spark, workdir, monkeypatch):
    spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 3) AS ts",
        "id % 7 AS user_id").repartition(4).write.parquet(f"{workdir}/events.parquet")
    staged = []

    def keep(rows, folder):
        staged.append(rows.rdd.getNumPartitions())
        if len(staged) == 2:
            raise Crash("staged")

    monkeypatch.setattr(scenarios, "_clean", keep)
    with pytest.raises(Crash):
        scenarios.streamed_store(spark, workdir)
    assert min(staged) > 1
