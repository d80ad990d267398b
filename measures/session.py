"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that carry meaning, not just speed: all timestamps are UTC wall
# clocks, and roll-up / enrollment rewrites replace only the partitions they
# touch.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Text with an offset is read as an instant (then kept as its UTC wall
    # clock); an NTZ default would drop the offset instead.
    "spark.sql.timestampType": "TIMESTAMP_LTZ",
}

# Settings for scale: runtime re-planning, skew splitting, partition
# coalescing.  Applied by build_session; a caller's own session keeps its own.
PERFORMANCE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Checkpoints cut lineage before partition rewrites; remove their files
    # once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "measures",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for this library.

    By default the master and the shuffle partition count are the launcher's
    (spark-submit on a cluster, local[*] otherwise).  On a cluster, size the
    latter to the data (roughly input bytes / 128 MB); AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**PERFORMANCE_CONF, **SEMANTIC_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to an existing session."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application."""
    sc = spark.sparkContext
    name = f"measures-{sc.applicationId}.zip"
    if any(str(f).endswith(name) for f in sc.listFiles):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="measures-ship-"), name)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)  # served by the driver to every executor


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session; only when nothing is configured and the master is
    local (tests) is a folder under the session's warehouse directory chosen
    and registered as the checkpoint directory.  On a cluster that would be
    the driver's own disk, so it is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        configured = warehouse.rstrip("/") + "/_measures_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"
