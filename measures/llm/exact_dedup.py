"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text, one row
per distinct text ever taken in.  A batch is reduced to one row per distinct
text (partial aggregation before the shuffle), anti-joined with the index by
a sort-merge join that reads the index bucket by bucket without shuffling it,
and what is new is appended.  A replayed batch adds nothing.

Rules
- null text counts as empty; two texts are equal when their bytes are.
- of equal texts in the batch that brings the text in, the row with the
  largest id stays; later batches lose every row with a known text.
- a null id is smaller than any other; rows that share an id are one document
  and stay or go together.  An empty batch gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.llm.common import cut_lineage

BUCKETS = 64


class DigestIndex:
    """Digest table `name` (digest binary, keep_id bigint), created on first use."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS):
        self.spark, self.name, self.buckets = spark, name, buckets
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT) USING parquet "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
        """Take a batch in; per row: id, digest, keep_id (the row that stays),
        group_size (rows of the batch with this text), kept."""
        rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                           digest_of(F.col(text_col)).alias("digest"))
        groups = cut_lineage(rows.groupBy("digest").agg(
            F.max("id").alias("last_id"), F.count(F.lit(1)).alias("group_size")))
        fresh = groups.hint("merge").join(self.read(), "digest", "left_anti")
        (fresh.select("digest", F.col("last_id").alias("keep_id"))
         .repartition(self.buckets, "digest")
         .write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))
        known = cut_lineage(groups.hint("merge").join(self.read(), "digest")
                            .select("digest", "keep_id", "group_size"))
        # Both sides are shuffled here, so that the many rows of one text can
        # be split over tasks by the skew rule.
        return (rows.hint("merge").join(known, "digest")
                .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))))


def digest_of(text) -> "F.Column":
    """SHA-256 of the text's UTF-8 bytes, as binary; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
