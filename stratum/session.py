"""Session factory and shared-storage helpers.

The session settings are the ones the library relies on for correctness
(UTC session zone, ANSI arithmetic) plus AQE for runtime re-planning.
Nothing here overrides a setting the cluster already made: ``get_session``
only fills gaps, and ``scratch_dir`` reads ``spark.checkpoint.dir`` from the
session, creating a local one only when none is configured (tests, laptop).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library needs. Each is applied only when the loaded configuration
# does not set it, so a cluster's own tuning, submit options included, wins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what the planner has measured to be below this size;
    # everything else falls back to a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}

# Settings for layered runs over large tables, with Spark's own defaults: applied where
# the session still has the default. A run makes many tables one after another; the
# shuffle files of each go when it is written, not when the driver next collects garbage.
# Smaller splits let the sorts before a shuffle fit the memory of a task.
LARGE_RUN_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": ("false", "true"),
    "spark.sql.files.maxPartitionBytes": (str(128 * 1024 * 1024) + "b", "32m"),
}


def get_session(app_name: str = "stratum", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(extra or {})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in DEFAULT_CONF.items():
        if key not in given:
            spark.conf.set(key, value)
    large_run_settings(spark)
    return spark


def ensure_settings(spark: SparkSession) -> None:
    """Pin the settings results depend on (zone, ANSI) on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


def large_run_settings(spark: SparkSession, wanted: bool = True) -> None:
    """Set LARGE_RUN_CONF, or (not ``wanted``) take it back; a value that is neither
    Spark's default nor ours is the cluster's own and stays."""
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, (default, ours) in LARGE_RUN_CONF.items():
        if key not in given and spark.conf.get(key, default) in (default, ours):
            spark.conf.set(key, ours if wanted else default)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    This is ``spark.checkpoint.dir``, which on a cluster is a file system that
    every executor can reach. Only where the session has none and driver and
    executors are one process, as in tests, is a fresh local folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
            "(HDFS / object store) that every executor can reach")
    local = tempfile.mkdtemp(prefix="stratum-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def new_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-before-used location under the shared scratch folder."""
    return f"{scratch_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
