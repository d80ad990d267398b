"""Conflicts of jobs do not grow with the ids they share."""

from pyspark.sql import functions as F

from measures.operators import constraints


def test_ids_at_the_same_jobs_are_one(spark):
    edges = spark.range(600).selectExpr(
        "'s' AS study_id", "cast(id AS string) AS id",
        "explode(CASE WHEN id % 3 = 0 THEN array('a', 'b') WHEN id % 3 = 1 THEN array('b', 'c')"
        " ELSE array('c') END) AS job_id").withColumn("rank", F.col("job_id"))
    kept = constraints.one_id_per_job_set(edges).collect()
    assert sorted(r.job_id for r in kept) == ["a", "b", "b", "c"]
    assert [r.job_id for r in constraints.first_accepted(edges).collect()] == ["b"]
