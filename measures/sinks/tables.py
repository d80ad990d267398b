"""Table maintenance (K1-K4): appends, insert-if-absent and partition rewrites.

All writes go through a `Commit` (sources/store.py): rows are written to the
commit's own folders, and what they replace is superseded in the manifest.
Nothing that is read is ever overwritten, so a merge needs no checkpoint and a
crash at any point leaves the published version whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.operators import dimensions, rollup
from measures.sources.store import PARTITIONS, Commit, Store

# Upper bound on rows per written file: keeps files near row-group friendly
# sizes whatever a task holds.
MAX_RECORDS_PER_FILE = 5_000_000
CLUSTERED = {"rollup": ("study_id", "measurement_type", "participant_id"),
             "rollup_partials": ("study_id", "measurement_type", "participant_id"),
             "measurements": ("measurement_type", "participant_id", "timestamp")}
FACT_COLUMNS = ("id", "study_id", "participant_id", "site_id", "measurement_type", "value",
                "unit", "timestamp", "quality_score", "processed_at", "created_at", "value_num",
                "bp_systolic", "bp_diastolic", "job_id", "load_id")


@contextmanager
def committing(spark: SparkSession, store: Store) -> Iterator[Commit]:
    """A commit published when the block ends without an error."""
    commit = store.begin(spark)
    yield commit
    commit.publish()


def _write(commit: Commit, df: DataFrame, table: str) -> None:
    w = df.write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if table in PARTITIONS:
        w = w.partitionBy(*PARTITIONS[table])
    w.parquet(commit.target(table))


def append_keys(commit: Commit, table: str, key: str, incoming: DataFrame) -> None:
    """K2 via J2: add keys not stored yet (studies, participants, sites)."""
    stored = commit.read(commit.spark, table)
    _write(commit, dimensions.insert_if_absent(stored, incoming, key), table)


def append_facts(commit: Commit, facts: DataFrame) -> None:
    """K1: append accepted measurements.  No shuffle: each task sorts what it
    holds by (study, type, participant, time) and writes one file per study
    it holds, so a study with a third of all rows is written by every task,
    not by one.  The sort clusters each measurement type in its own row
    groups (type filters of Q2, Q7, R1 skip the rest), keeps participants and
    times ordered within a type, and a load's files span only its own time
    window (time filters of Q5, R1 and the duplicate check skip older
    files)."""
    out = facts.select(*FACT_COLUMNS).sortWithinPartitions(
        "study_id", "measurement_type", "participant_id", "timestamp")
    _write(commit, out, "measurements")


def touched_keys(df: DataFrame, key: str) -> list:
    """Distinct partition values a batch touches (studies or days: a short list)."""
    return [r[0] for r in df.select(key).distinct().collect()]


def _rewrite_partitions(commit: Commit, table: str, merged: DataFrame,
                        dealt: bool = False) -> None:
    """The partitions present in `merged` take the place of the stored ones.
    `dealt`: `merged` is read from files of one partition value each, and its
    rows stay where they are."""
    part = PARTITIONS[table]
    # Rebalance on the partition column: each day (or study) is written by a
    # few tasks instead of every task writing a file into every partition;
    # AQE splits a partition that is unusually large, so no task gets a skew.
    # Inside a file, rows are ordered as queries filter them.
    _write(commit, (merged if dealt else merged.hint("rebalance", *part)).sortWithinPartitions(
        *part, *CLUSTERED.get(table, ())), table)
    commit.supersede(table)


def merge_enrollments(commit: Commit, first_seen: DataFrame, studies: list[str]) -> None:
    """K3: first-seen per (participant, study), keeping the earliest; rewrites
    only the touched study partitions."""
    old = commit.read_partitions(commit.spark, "enrollments", studies)
    _rewrite_partitions(commit, "enrollments", dimensions.merge_enrollments(old, first_seen))


def merge_rollup(commit: Commit, facts: DataFrame, load_id: str, days: list,
                 rule: str = "faithful") -> None:
    """K4: merge the batch's daily buckets into the stored roll-up.  Only the
    batch's days are read and rewritten.  `rule="exact"` maintains partial sums
    instead (A6), from which the touched days are derived anew."""
    spark, stamp = commit.spark, F.lit(load_id)
    if rule == "faithful":
        new, old = rollup.daily_rollup(facts), commit.read_partitions(spark, "rollup", days)
        merged = new if old is None else rollup.merge_faithful(old.drop("load_id"), new)
        _rewrite_partitions(commit, "rollup", merged.withColumn("load_id", stamp))
    elif rule == "exact":
        old = commit.read_partitions(spark, "rollup_partials", days)
        merged = rollup.rollup_partials(facts) if old is None else rollup.merge_exact(
            old.drop("load_id"), rollup.stored_partials(rollup.row_partials(facts)))
        _rewrite_partitions(commit, "rollup_partials",
                            rollup.stored_partials(merged).withColumn("load_id", stamp))
        partials = commit.read_partitions(spark, "rollup_partials", days)
        if partials is not None:
            _rewrite_partitions(commit, "rollup", rollup.finalize_partials(partials)
                                .withColumn("load_id", stamp), dealt=True)
    else:
        raise ValueError(f"unknown roll-up rule {rule!r}")


def append_ledger(commit: Commit, events: DataFrame) -> None:
    """L2: the ledger is append-only; a job's state is its latest event.
    Events are job-level (a few per file loaded), under the day they happened."""
    _write(commit, events.withColumn("event_day", F.to_date("event_at"))
           .hint("rebalance", "event_day"), "jobs")


def append_seen(commit: Commit, files: DataFrame) -> None:
    """Record the files (path, modified) that a load has taken."""
    _write(commit, files, "seen_files")


def append_consumed(commit: Commit, folders: DataFrame) -> None:
    """Record the fact folders that a roll-up has merged."""
    _write(commit, folders, "consumed")


def compact(spark: SparkSession, store: Store, table: str, keep: list[str] | None = None) -> int:
    """Rewrite each partition that several commits have written (but for the
    partition folders named in `keep`) into one commit's folder, rows as they
    are.  Returns the number of partitions rewritten."""
    held: dict[str, list[str]] = {}
    for f in store.folders(spark, table):
        held.setdefault(f.split("/")[1], []).append(f)
    crowded = {p: fs for p, fs in held.items() if len(fs) > 1 and p not in (keep or ())}
    if crowded:
        with committing(spark, store) as commit:
            _rewrite_partitions(commit, table, commit._read(
                spark, table, [f for fs in crowded.values() for f in fs]))
    return len(crowded)


def compact_ledger(spark: SparkSession, store: Store, before: dt.date | None = None) -> int:
    """Compact the closed days of the ledger (days before `before`, default
    today UTC).  The history stays whole; only the file count shrinks."""
    before = before or dt.datetime.now(dt.timezone.utc).date()
    open_days = [p for p in (f.split("/")[1] for f in store.folders(spark, "jobs"))
                 if p.split("=")[1] >= before.isoformat()]
    return compact(spark, store, "jobs", open_days)


def delete_keys(spark: SparkSession, store: Store, studies: DataFrame | None = None,
                participants: DataFrame | None = None, sites: DataFrame | None = None) -> None:
    """V8 on the stored tables, in one commit: the given keys (a DataFrame of
    one column each) go, with the enrollments and measurements that refer to
    them; jobs stay, without their study.

    A deleted study's partitions are superseded as a whole and never read.
    Elsewhere only the partitions that hold a deleted key are rewritten, by
    anti-joins on the keys.  The roll-up has no foreign keys and stays, as in
    the reference."""
    from measures.operators import constraints
    with committing(spark, store) as commit:
        constraints.cascade_stored(commit, studies, participants, sites, _write)
