"""The daily roll-up as a stream, in two forms.

`streaming_daily_rollup` is a watermarked aggregation for live dashboards: days
behind the watermark are closed, and later rows are left out.

`start_rollup_stream` keeps an exact roll-up in a store of its own: every beat
takes the fact folders committed since the last one and merges their partial
sums into the stored ones, however late their rows are.  The folders taken are
recorded in the same commit, so a beat that fails or is replayed counts nothing
twice.  When the source has rewritten folders already taken (compaction, a
deletion), the beat starts over from the source's present version.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from measures.functions.parsing import as_day, is_low_quality
from measures.operators.rollup import exact_avg
from measures.sinks import tables
from measures.sources.store import COMMIT, STORED_FACT_SCHEMA, Store


def stream_facts(spark, store: Store, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stored measurements as a stream (new fact files as they are written)."""
    reader = spark.readStream.schema(T.StructType(
        STORED_FACT_SCHEMA.fields + [T.StructField(COMMIT, T.StringType())]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(store.path("measurements")).drop(COMMIT)


def streaming_daily_rollup(facts: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Event-time watermarks need a TIMESTAMP (not TIMESTAMP_NTZ) column, so the
    UTC wall clock is re-read as an instant under the UTC session zone."""
    event_time = F.col("timestamp").cast("timestamp")
    return (facts.withColumn("event_time", event_time)
            .withWatermark("event_time", lateness)
            .groupBy(F.window("event_time", "1 day").alias("day"), "study_id", "site_id",
                     "participant_id", "measurement_type")
            .agg(F.count(F.lit(1)).alias("measurement_count"),
                 F.avg("value_num").alias("avg_value"),
                 F.min("value_num").alias("min_value"),
                 F.max("value_num").alias("max_value"),
                 F.avg("bp_systolic").alias("avg_systolic"),
                 F.avg("bp_diastolic").alias("avg_diastolic"),
                 exact_avg("quality_score").alias("avg_quality_score"),
                 F.sum(is_low_quality("quality_score").cast("int")).cast("long")
                 .alias("low_quality_count"))
            .select(F.to_date(F.col("day.start")).alias("agg_day"), "study_id", "site_id",
                    "participant_id", "measurement_type", "measurement_count", "avg_value",
                    "min_value", "max_value", "avg_systolic", "avg_diastolic",
                    "avg_quality_score", "low_quality_count"))


def merge_new_facts(spark: SparkSession, source: Store, target: Store, load_id: str) -> int:
    """One beat: merge the source's new fact folders into the target's roll-up.
    Returns the number of folders taken."""
    held = set(source.folders(spark, "measurements"))
    taken = {r["folder"] for r in target.read_or_empty(spark, "consumed").toLocalIterator()}
    commit = target.begin(spark)
    if taken - held:
        commit.kept = {}
        taken = set()
    new = sorted(held - taken)
    if not new:
        return 0
    facts = source._read(spark, "measurements", new)
    days = tables.touched_keys(facts.select(as_day("timestamp").alias("day")), "day")
    tables.merge_rollup(commit, facts, load_id, days, "exact")
    tables.append_consumed(commit, spark.createDataFrame([(f,) for f in new], "folder string"))
    commit.publish()
    return len(new)


def start_rollup_stream(spark: SparkSession, source: Store, target: Store, checkpoint: str,
                        available_now: bool = True,
                        processing_time: str | None = None) -> StreamingQuery:
    """Keep `target`'s roll-up equal to a recompute over `source`'s facts."""
    key = hashlib.md5(checkpoint.encode("utf-8")).hexdigest()[:12]

    def beat(batch: DataFrame, batch_id: int) -> None:
        merge_new_facts(batch.sparkSession, source, target, f"rollup-{key}-{batch_id}")

    writer = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
              .writeStream.foreachBatch(beat).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
