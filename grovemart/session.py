"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Map-only jobs write one file per split: larger splits, fewer and larger files. Small
    # inputs are still spread over all cores.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Partitioned writes keep a few files open per task instead of sorting every row.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}

_local_dirs: dict[str, str] = {}


def get_session(app_name: str = "grovemart", conf: dict[str, str] | None = None) -> SparkSession:
    """The one session of a run. Master, memory and file systems come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def unsorted_writes(spark: SparkSession) -> None:
    """Partitioned writes of a session that was not made here keep a few files open, too, unless it says otherwise."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if spark.conf.get(name, "0") == "0":
        spark.conf.set(name, DEFAULTS[name])


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only a session on a local master, where driver and executors share a machine, may
    fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="grovemart-")
    return _local_dirs[app]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing else ever writes there."""
    app = spark.conf.get("spark.app.id")
    return f"{shared_dir(spark)}/grovemart/{app}/{name}-{uuid.uuid4().hex[:12]}"


def runs_folder(spark: SparkSession) -> str:
    """Where the intermediate tables of all sessions lie, a folder for each."""
    return f"{shared_dir(spark)}/grovemart"
