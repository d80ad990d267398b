"""A training-corpus pipeline over `documents`, one operator per stage.

Each stage takes what its predecessor kept, as Parquet in the shared folder,
and returns rows with the same columns; the last adds the place of each row in
the mix.  Rows keep all their columns, whatever these are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.llm import decontaminate, exact_dedup, jaccard, mixing, toxicity
from measures.llm.common import cut_lineage, shared_path
from measures.llm.queries import MIX_SHARES, TOXIC_AT, fresh_name

BROADCAST_ROWS = 300_000  # at most 20 MB of rejected keys; more are joined by a shuffle


def unclashing(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names that no operator's own columns can clash
    with, and the new names by the old ones."""
    names = {c: f"c{i}_" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def without(docs: DataFrame, rejected: DataFrame, on) -> DataFrame:
    """docs but for the rejected rows; few rejected keys are broadcast."""
    if rejected.count() <= BROADCAST_ROWS:
        rejected = F.broadcast(rejected)
    return docs.join(rejected, on, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, names = unclashing(docs)
    scored = toxicity.score(rows, index, names["doc_id"], names["text"], keep=rows.columns)
    return scored.where(F.col("score") < TOXIC_AT).select(*rows.columns).toDF(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = unclashing(docs)
    index = exact_dedup.DigestIndex(spark, fresh_name("digest_index"))
    gone = index.ingest(rows, names["doc_id"], names["text"]).where("NOT kept").select(
        F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    return without(rows, cut_lineage(gone), F.expr(f"{names['doc_id']} <=> gone_id") & (
        exact_dedup.digest_of(F.col(names["text"])) == F.col("gone_digest"))).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component stays."""
    rows, names = unclashing(docs)
    found = jaccard.jaccard_components(rows, names["doc_id"], names["text"])
    gone = found.where("id <> component_id").select(F.col("id").alias("gone_id")).distinct()
    return without(rows, cut_lineage(gone), F.expr(f"{names['doc_id']} = gone_id")).toDF(
        *docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = unclashing(docs)
    found = decontaminate.find_contamination(
        rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), names["doc_id"], names["text"],
        keep=rows.columns)
    return decontaminate.contaminated(found).where("NOT contaminated").select(
        *rows.columns).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds `slot` and `place` (with `mix_` before a name that is taken): ordering
    by them gives the mix."""
    def free(name: str) -> str:
        return free(f"mix_{name}") if name in docs.columns else name

    order = [F.col(c).alias(free(c)) for c in ("slot", "place")]
    return mixing.mix(docs, MIX_SHARES, whole_rows=True).select("row.*", *order)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

# Nearest-neighbour votes have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = shared_path(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{i}")
        docs = spark.read.parquet(f"{path}/{i}")
    return docs
