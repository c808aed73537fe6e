"""Session settings the engine expects, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Skewed or tiny shuffle partitions are re-planned at run time; the event log never meets a zone shift.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", app_name: str = "earshot", **extra: str) -> SparkSession:
    """A session with the settings above; `extra` overrides them (dots in keys via dict unpacking)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settings_for(log_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a log of that size: the one big shuffle carries about as much as the log has, so it
    is cut into partitions an executor core can hold, which adaptive execution merges where less is left.
    """
    partitions = max(200, -(-log_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below `spark.checkpoint.dir`, which every executor can reach.

    Where the session names none, a temporary folder of this machine is used under a local master
    (tests, trial runs), whose only executor is the driver; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="earshot-")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")
