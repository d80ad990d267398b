"""Key constraints Parquet does not enforce: primary key (V6), foreign keys
(V7) and cascading deletes (V8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measures.session import scratch_dir
from measures.sources.store import PARTITIONS, Commit, partition_name

DUP_IN_FILE = "Load error: duplicate key value violates unique constraint (id repeated in the file)"
DUP_STORED = "Load error: duplicate key value violates unique constraint (id already stored)"
DUP_BATCH = ("Load error: duplicate key value violates unique constraint "
             "(id loaded by an earlier job)")
DUP_CHANGED = ("Load error: duplicate key value violates unique constraint "
               "(id stored by this job with other values)")
KEY = ("study_id", "id")
REJECTIONS = "job_id string, message string"


def content_hash() -> Column:
    """What a row says besides its key: two rows of one id with different
    hashes are not the same measurement."""
    return F.xxhash64("participant_id", "site_id", "measurement_type", "value", "unit",
                      "timestamp", "quality_score")


def _written(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared scratch folder, read from there on."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_ids_for(stored: DataFrame, windows: dict[str, tuple]) -> DataFrame:
    """Stored rows that could collide with a batch covering `windows` (study ->
    first and last timestamp).

    The id hashes study and timestamp, so only rows of the batch's studies and
    time span can: the study list prunes partitions and the time bounds prune
    row groups of timestamp-sorted files."""
    spans = [(F.col("study_id") == F.lit(study)) & F.col("timestamp").between(F.lit(lo), F.lit(hi))
             for study, (lo, hi) in windows.items()]
    near = reduce(lambda a, b: a | b, spans, F.lit(False))
    return stored.where(F.col("study_id").isin(list(windows)) & near).select(
        *KEY, F.col("job_id").alias("stored_job_id"), content_hash().alias("stored_content"))


def resolve_duplicates(candidates: DataFrame, stored_ids: DataFrame | None = None
                       ) -> tuple[DataFrame, bool]:
    """V6 with the reference's sequential semantics.

    `candidates`: rows (job_id, rank, study_id, id, content) of files that
    passed every other check; `rank` orders the jobs (submission time, then
    id).  A file is rejected when an id repeats inside it, is stored by another
    job (or by itself with other values), or was loaded by an earlier accepted
    file of this batch.  A rejected file blocks nobody.

    Returns (job_id, message) of the rejected jobs, and whether rows of a job
    are stored already under its own id (the job was sent again).
    """
    spark = candidates.sparkSession
    rejected = spark.createDataFrame([], REJECTIONS)
    again = False
    if stored_ids is not None:
        hits = _written(candidates.join(stored_ids, list(KEY)).groupBy("job_id").agg(
            F.max(F.col("stored_job_id") != F.col("job_id")).alias("foreign"),
            F.max((F.col("stored_job_id") == F.col("job_id"))
                  & (F.col("content") != F.col("stored_content"))).alias("changed")), "stored-hits")
        rejected = hits.where("foreign OR changed").select(
            "job_id", F.when(F.col("foreign"), DUP_STORED).otherwise(DUP_CHANGED).alias("message"))
        again = hits.where("NOT foreign").limit(1).count() > 0
    # Hashes of ids that occur more than once; counted before the shuffle, so
    # neither a hot id nor a large file is gathered.
    hashed = candidates.dropna(subset=list(KEY)).withColumn("key_hash", F.xxhash64(*KEY))
    shared = _written(hashed.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                      .select("key_hash"), "shared-ids")
    if shared.limit(1).count() == 0:
        return rejected, again
    # One row per (id, job) of these ids.  An id that merely shares its hash
    # with another has one row, which no check below minds.
    edges = _written(hashed.join(shared, "key_hash", "left_semi")
                     .groupBy(*KEY, "job_id", "rank").agg(F.count(F.lit(1)).alias("n")), "id-jobs")
    in_file = (edges.where("n > 1").select("job_id").distinct()
               .join(rejected, "job_id", "left_anti")
               .withColumn("message", F.lit(DUP_IN_FILE)))
    rejected = rejected.unionByName(in_file)
    late = first_accepted(edges.join(rejected, "job_id", "left_anti").select(*KEY, "job_id", "rank"))
    return rejected.unionByName(late.withColumn("message", F.lit(DUP_BATCH))), again


def one_id_per_job_set(edges: DataFrame) -> DataFrame:
    """(key, job) rows of the least id of each set of jobs that share ids: ids at
    the same jobs decide alike.  Ids of one job stay out, they decide nothing.

    A set is known by its size and two 64-bit sums over its jobs, so that no set
    is gathered."""
    each = edges.select(*KEY, "job_id", "rank").distinct()

    def total(salt: int) -> Column:
        return F.sum(F.xxhash64("job_id", F.lit(salt)).cast("decimal(20,0)"))

    sets = each.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"),
                                  total(2).alias("b")).where("n > 1")
    kept = sets.groupBy("n", "a", "b").agg(F.min(F.struct(*KEY)).alias("key")).select("key.*")
    return each.join(kept, list(KEY), "left_semi").select(*KEY, "job_id", "rank")


def first_accepted(edges: DataFrame) -> DataFrame:
    """(job_id) of the jobs that lose: taken in order of rank, a job loses when
    an earlier job that did not lose shares an id with it.

    Rounds of min-rank propagation over (id, job) rows: a job that comes first
    at all its ids is accepted, whoever shares an id with it loses, and both
    leave with their rows.  As many rounds as the longest chain of jobs of which
    each hangs on the one before; every round is two aggregations over one id
    for each set of jobs that share ids, however many ids they share."""
    spark = edges.sparkSession
    lost = spark.createDataFrame([], "job_id string")
    open_ = _written(one_id_per_job_set(edges), "open-jobs")
    while open_.limit(1).count():
        first = open_.groupBy(*KEY).agg(F.min("rank").alias("first"))
        judged = open_.join(first, list(KEY))
        accepted = (judged.groupBy("job_id").agg(F.min(F.col("rank") == F.col("first")).alias("ok"))
                    .where("ok").select("job_id"))
        state = _written(
            open_.join(accepted.withColumn("accepted", F.lit(True)), "job_id", "left")
            .withColumn("taken", F.col("accepted").isNotNull()), "round")
        taken = state.where("taken").select(*KEY).distinct()
        losers = _written(state.where("NOT taken").join(taken, list(KEY), "left_semi")
                          .select("job_id").distinct(), "losers")
        lost = lost.unionByName(losers)
        open_ = _written(state.where("NOT taken").join(losers, "job_id", "left_anti")
                         .select(*KEY, "job_id", "rank"), "open-jobs")
    return lost


def fk_orphans(facts: DataFrame, studies: DataFrame, sites: DataFrame,
               participants: DataFrame, enrollments: DataFrame) -> DataFrame:
    """V7: rows whose foreign key has no parent, counted per constraint.

    The facts are read once and reduced to one row per key combination before
    anything is joined, so a key with a third of all rows is one row."""
    keys = ["study_id", "site_id", "participant_id"]
    fact_keys = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    checks = [
        ("measurement.study_id -> studies", fact_keys, studies, ["study_id"]),
        ("measurement.site_id -> sites", fact_keys, sites, ["site_id"]),
        ("measurement.(participant_id, study_id) -> enrollments", fact_keys, enrollments,
         ["participant_id", "study_id"]),
        ("enrollment.participant_id -> participants", enrollments.withColumn("n", F.lit(1)),
         participants, ["participant_id"]),
        ("enrollment.study_id -> studies", enrollments.withColumn("n", F.lit(1)), studies,
         ["study_id"]),
    ]
    out = None
    for name, children, parents, on in checks:
        # A NULL foreign key refers to nothing and is no orphan.
        part = (children.groupBy(*on).agg(F.sum("n").alias("n")).dropna(subset=on)
                .join(parents.select(*on), on, "left_anti")
                .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
                .select(F.lit(name).alias("constraint"), "orphan_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def _without(df: DataFrame, column: str, keys: DataFrame | None) -> DataFrame:
    if keys is None:
        return df
    return df.join(keys.toDF(column).distinct(), column, "left_anti")


def cascade_delete(tables: dict[str, DataFrame], studies: DataFrame | None = None,
                   participants: DataFrame | None = None,
                   sites: DataFrame | None = None) -> dict[str, DataFrame]:
    """V8: remove deleted keys (DataFrames of one column) and everything that
    references them; jobs keep their row with study_id set to NULL.  Returns
    the new table contents."""
    keys = {"study_id": studies, "participant_id": participants, "site_id": sites}
    refers = {"studies": ["study_id"], "participants": ["participant_id"], "sites": ["site_id"],
              "enrollments": ["study_id", "participant_id"],
              "measurements": ["study_id", "participant_id", "site_id"]}
    out = dict(tables)
    for name, columns in refers.items():
        if out.get(name) is not None:
            order = out[name].columns
            out[name] = reduce(lambda df, c: _without(df, c, keys[c]), columns,
                               out[name]).select(*order)
    if studies is not None and out.get("jobs") is not None:
        gone = studies.toDF("gone_study").distinct()
        jobs = out["jobs"]
        out["jobs"] = jobs.join(gone, F.col("study_id") == F.col("gone_study"), "left").select(
            *[F.when(F.col("gone_study").isNull(), F.col("study_id")).alias("study_id")
              if c == "study_id" else c for c in jobs.columns])
    return out


def cascade_stored(commit: Commit, studies: DataFrame | None, participants: DataFrame | None,
                   sites: DataFrame | None, write) -> None:
    """`cascade_delete` of a commit's stored tables, touched partitions only."""
    spark = commit.spark
    given = {"study_id": studies, "participant_id": participants, "site_id": sites}
    keys = {c: df.toDF(c).distinct().dropna() for c, df in given.items() if df is not None}
    for table, column in (("studies", "study_id"), ("participants", "participant_id"),
                          ("sites", "site_id")):
        old = commit.folders(spark, table)
        if column in keys and old:
            kept = commit.read(spark, table).join(keys[column], column, "left_anti")
            commit.drop_folders(table, set(old))
            write(commit, kept, table)
    for table in ("enrollments", "measurements"):
        folders = commit.folders(spark, table)
        if not folders:
            continue
        part = PARTITIONS[table][0]
        whole = set()
        if part in keys:  # partitions, not rows: one name per deleted study
            names = {partition_name(spark, part, r[0]) for r in keys[part].toLocalIterator()}
            whole = {f for f in folders if f.split("/")[1] in names}
            commit.drop_folders(table, whole)
        rest = [f for f in folders if f not in whole]
        others = [c for c in keys if c != part and (c != "site_id" or table == "measurements")]
        if rest and others:
            rows = commit._read(spark, table, rest)
            hit = {partition_name(spark, part, r[0]) for c in others for r in
                   rows.join(keys[c], c, "left_semi").select(part).distinct().toLocalIterator()}
            touched = [f for f in rest if f.split("/")[1] in hit]
            if touched:
                commit.drop_folders(table, set(touched))
                write(commit, reduce(lambda df, c: df.join(keys[c], c, "left_anti"), others,
                                     commit._read(spark, table, touched)), table)
    if "study_id" in keys and commit.folders(spark, "jobs"):
        events = commit.read(spark, "jobs")
        hit = {partition_name(spark, "event_day", r[0]) for r in
               events.join(keys["study_id"], "study_id", "left_semi").select("event_day")
               .distinct().toLocalIterator()}
        touched = [f for f in commit.folders(spark, "jobs") if f.split("/")[1] in hit]
        if touched:
            kept = cascade_delete({"jobs": commit._read(spark, "jobs", touched)},
                                  studies=keys["study_id"])["jobs"]
            commit.drop_folders("jobs", set(touched))
            write(commit, kept, "jobs")
