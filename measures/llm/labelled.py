"""Labelled rows for the learned operators: folds and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measures.llm.common import cut_lineage


def is_held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, mod 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learning_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int,
                    text_bytes: int | None = None) -> DataFrame:
    """At most `rows` labelled learning rows as (doc_id, y, text), written once.

    The rows with the smallest hashes of their ids are taken, so the sample is
    the same on every run.  Repeated labels of an id count once (the largest).
    With `text_bytes`, texts above a 32nd of that are passed over and the others
    are taken in that order while they fit.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .where(~is_held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # At most `rows` ids are broadcast.
    sample = cut_lineage(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text"))
    if text_bytes is None:
        return sample
    # Ids and lengths only: at most `rows` of them, with repeats of an id summed.
    sizes = sample.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("size"))
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    fit = (sizes.where(F.col("size") <= text_bytes // 32).withColumn("so_far", so_far)
           .where(F.col("so_far") <= text_bytes).select("doc_id"))
    return cut_lineage(sample.join(F.broadcast(fit), "doc_id"))
