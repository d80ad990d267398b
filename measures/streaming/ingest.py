"""Incremental ingestion of files dropped into a landing folder.

Every beat of the stream lists the folder, takes the files that no earlier beat
has taken (an anti-join with the store's `seen_files`), and hands them to the
batch load, whole jobs at a time.  The files taken are recorded in the same
commit as the load itself, so a beat that fails anywhere, or is replayed, takes
them again and nothing is counted twice.  Beats run one after another, so loads
never merge into the roll-up concurrently.

The listing names zero-length files too, which a file stream never yields: their
jobs fail as unreadable.  A file that arrives for a job taken before brings the
job's other files with it: the job is judged whole again, and rows it has stored
already are not stored twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from measures.plans import loading
from measures.sinks import tables
from measures.sources import landing
from measures.sources.store import Store

# Files per load: Spark's readers get their paths from the driver.
FILES_PER_TRIGGER = 10_000
EPOCH = "timestamp_ntz'1970-01-01'"


def pending_files(spark: SparkSession, landing_root: str, store: Store, glob: str = "*.csv",
                  settle_seconds: int = 0) -> DataFrame:
    """(job_id, path, modified) of all files of the jobs that have an unseen
    file, once none of the job's files is younger than `settle_seconds`."""
    listing = landing.list_files(spark, landing_root, glob).select("path", "modified")
    every = listing.unionByName(landing.empty_files(listing, listing), allowMissingColumns=True)
    files = every.select(landing.canonical_path(F.col("path")).alias("path"),
                         F.coalesce("modified", F.expr(EPOCH)).alias("modified")).select(
        landing.job_id_of(F.col("path")).alias("job_id"), "path", "modified")
    seen = store.read_or_empty(spark, "seen_files")
    new = files.join(seen, ["path", "modified"], "left_anti").select("job_id").distinct()
    ready = files.groupBy("job_id").agg(F.max("modified").alias("latest")).where(
        F.col("latest") <= F.current_timestamp().cast("timestamp_ntz")
        - F.expr(f"INTERVAL {int(settle_seconds)} SECONDS")) if settle_seconds else None
    jobs = new if ready is None else new.join(ready, "job_id", "left_semi")
    return files.join(jobs, "job_id", "left_semi")


def next_jobs(pending: DataFrame, max_files: int) -> DataFrame:
    """The first jobs, oldest first, that hold `max_files` files together (the
    first one whatever it holds): a job is never split."""
    sizes = (pending.groupBy("job_id").agg(F.min("modified").alias("at"), F.count("*").alias("n"))
             .orderBy("at", "job_id").limit(max_files).collect())  # at most a load's files
    taken, files = [], 0
    for r in sizes:
        if taken and files + r["n"] > max_files:
            break
        taken.append((r["job_id"],))
        files += r["n"]
    return pending.sparkSession.createDataFrame(taken, "job_id string")


def ingest_pending(spark: SparkSession, landing_root: str, store: Store, load_id: str,
                   glob: str = "*.csv", max_files: int | None = FILES_PER_TRIGGER,
                   settle_seconds: int = 0, **load_options) -> int:
    """Load everything that waits in the landing folder, `max_files` files at a
    time.  Returns the number of loads."""
    loads = 0
    while True:
        pending = landing.written(pending_files(spark, landing_root, store, glob, settle_seconds),
                                  "pending")
        batch = pending.join(next_jobs(pending, max_files or FILES_PER_TRIGGER), "job_id",
                             "left_semi").select("path", "modified")
        paths = [landing.literal_path(r["path"]) for r in batch.toLocalIterator()]
        if not paths:
            return loads
        loading.run_load(spark, paths, store, load_id=f"{load_id}-{loads}", glob=glob,
                         also=lambda commit: tables.append_seen(commit, batch), **load_options)
        loads += 1


def start_ingest(spark: SparkSession, landing_root: str, store: Store, checkpoint: str,
                 glob: str = "*.csv", available_now: bool = True,
                 processing_time: str | None = None,
                 max_files_per_trigger: int | None = FILES_PER_TRIGGER,
                 settle_seconds: int = 0) -> StreamingQuery:
    """Start the ingestion stream.  `available_now` takes what is there and
    stops (scheduled runs); otherwise each processing-time trigger is a beat.
    A backlog is taken in loads of at most `max_files_per_trigger` files (more
    only for a single job that holds more), all of it, oldest jobs first.  With
    `settle_seconds` a job is left alone until its files have rested that long,
    for writers that drop a job's files one by one."""
    stream_key = hashlib.md5(checkpoint.encode("utf-8")).hexdigest()[:12]
    beats = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def beat(batch: DataFrame, batch_id: int) -> None:
        ingest_pending(batch.sparkSession, landing_root, store, f"stream-{stream_key}-{batch_id}",
                       glob, max_files_per_trigger, settle_seconds)

    writer = beats.writeStream.foreachBatch(beat).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
