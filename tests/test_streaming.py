"""X1 ingestion stream equals the batch load; X2 streaming roll-up equals A1."""

import os

from conftest import F1_JOB, F1_ROWS, F2_JOB, F2_ROWS, csv_text, write_file
from measures.operators import ledger, rollup
from measures.schema import ROLLUP_KEYS
from measures.sources.store import Store
from measures.streaming import start_ingest, stream_facts, streaming_daily_rollup


def test_ingest_stream_then_rollup_stream(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    store = Store(os.path.join(workdir, "store"))
    ckpt = os.path.join(workdir, "ckpt")
    q = start_ingest(spark, land, store, ckpt)
    q.awaitTermination(300)
    assert store.measurements(spark).count() == 12
    # A second file arrives; a new run picks up only that file.
    write_file(land, f"{F2_JOB}_b.csv", csv_text(F2_ROWS))
    q = start_ingest(spark, land, store, ckpt)
    q.awaitTermination(300)
    assert store.measurements(spark).count() == 21
    assert store.rollup(spark).count() == 21
    status = {r.job_id: r.status for r in ledger.current_jobs(store.jobs(spark)).collect()}
    assert status == {F1_JOB: "completed", F2_JOB: "completed"}

    live = (streaming_daily_rollup(stream_facts(spark, store))
            .writeStream.outputMode("complete").format("memory").queryName("rollup_live")
            .trigger(availableNow=True).start())
    live.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("rollup_live")
                 .select(*ROLLUP_KEYS, *rollup.MEASURES).collect())
    want = sorted(tuple(r) for r in rollup.daily_rollup(store.measurements(spark))
                  .select(*ROLLUP_KEYS, *rollup.MEASURES).collect())
    assert got == want


def test_one_file_per_micro_batch_rejects_later_copy(spark, workdir):
    import time as _time

    from conftest import F1B_JOB
    land = os.path.join(workdir, "landing")
    write_file(land, f"{F1_JOB}_a.csv", csv_text(F1_ROWS))
    _time.sleep(1.1)  # distinct modification times: the stream takes files oldest first
    write_file(land, f"{F1B_JOB}_b.csv", csv_text(F1_ROWS))
    store = Store(os.path.join(workdir, "store"))
    q = start_ingest(spark, land, store, os.path.join(workdir, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    jobs = {r.job_id: r for r in ledger.current_jobs(store.jobs(spark)).collect()}
    assert jobs[F1_JOB].status == "completed"
    assert jobs[F1B_JOB].status == "failed" and "already stored" in jobs[F1B_JOB].message
    assert store.measurements(spark).count() == 12
    assert len({r.load_id for r in store.jobs(spark).collect()}) == 2
