"""What a load may not grow with: code too long to be compiled, and roll-up days
without a new row."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import F1_JOB, F1_ROWS, F2_JOB, F2_ROWS, csv_text, write_file
from measures.functions import parsing
from measures.operators import rollup, validate
from measures.plans import loading
from measures.sources import landing
from measures.sources.store import Store

JVM_COMPILES = 8000  # bytes of a method; the JVM interprets longer ones


def method_sizes(df):
    jvm = df.sparkSession._jvm
    debug = getattr(getattr(jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    parts = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]


def test_typing_compiles(spark, workdir):
    write_file(f"{workdir}/land", f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    sizes = method_sizes(validate.transform(landing.scan(spark, f"{workdir}/land").rows))
    assert sizes and max(sizes) < JVM_COMPILES


def test_shortcuts_of_stripping_and_paths(spark):
    texts = ["a", " a", "a ", "\u00a0a", "a\u2003", "", "  ", "\n", "a b", "é", "\ta\r\n", "!~", "a\x00",
             "\x1f", "a\u0085", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", parsing.strip_ws("t").alias("s"),
        F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("plain")).collect()
    assert [r.s for r in got] == [r.plain for r in got]
    job = "0f8fad5b-d9cb-469f-a165-70867728950e"
    paths = {f"file:///x/{job}_a.csv": job, f"file:///x/landing_job={job}_a/part-1": job,
             f"file:///x/{job}_a/b/part-1": None, f"s3a://x/a%20b/{job}_c+d.csv": job,
             f"file:///{job}_x/{F1_JOB}_y": job, "file:///a/b+c%2Fd.csv": None}
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(
        "p", landing.job_id_of(F.col("p"), encoded=True).alias("job"),
        landing.canonical_path(F.col("p"), encoded=True).alias("path")).collect()
    assert all(r.job == paths[r.p] for r in rows if paths[r.p])
    assert {r.p: r.path for r in rows}["file:///a/b+c%2Fd.csv"] == "file:/a/b+c/d.csv"


def test_rows_and_stored_sums_meet_in_one_aggregation(spark):
    facts = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h), "s", "x", f"p{h % 2}", "glucose", v, b, b, q)
         for h, (v, b, q) in enumerate([(1.0, None, "0.90"), (None, 120, "0.99"), (3.0, 80, None),
                                        (None, None, None), (5.5, 90, "0.95")])],
        "timestamp timestamp_ntz, study_id string, site_id string, participant_id string, "
        "measurement_type string, value_num double, bp_systolic int, bp_diastolic int, q string"
    ).withColumn("quality_score", F.col("q").cast("decimal(3,2)"))
    want = rollup.daily_rollup(facts)
    old = rollup.stored_partials(rollup.rollup_partials(facts.where("hour(timestamp) < 2")))
    new = rollup.stored_partials(rollup.row_partials(facts.where("hour(timestamp) >= 2")))
    got = rollup.finalize_partials(rollup.stored_partials(rollup.merge_exact(old, new)))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_replay_rewrites_no_roll_up_day(spark, workdir):
    write_file(f"{workdir}/l1", f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    write_file(f"{workdir}/l2", f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    write_file(f"{workdir}/l2", f"{F2_JOB}_b.csv", csv_text(F2_ROWS))
    for rule, tables_ in (("exact", ("rollup", "rollup_partials")), ("faithful", ("rollup",))):
        store = Store(f"{workdir}/{rule}")
        loading.run_load(spark, f"{workdir}/l1", store, rollup_rule=rule)
        once = {t: store.folders(spark, t) for t in tables_}
        rows = sorted(map(str, store.rollup(spark).collect()))
        loading.run_load(spark, f"{workdir}/l1", store, rollup_rule=rule)
        assert {t: store.folders(spark, t) for t in tables_} == once
        assert sorted(map(str, store.rollup(spark).collect())) == rows
        loading.run_load(spark, f"{workdir}/l2", store, rollup_rule=rule)  # one new day
        assert all(set(once[t]) < set(store.folders(spark, t)) for t in tables_)
        assert store.measurements(spark).count() == len((F1_ROWS + "\n" + F2_ROWS).splitlines())
