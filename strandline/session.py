"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: str = "8", partitions: str = "8") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strandline")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` where the cluster sets it.

    Only a local master may fall back to a folder of its own; on a cluster such a folder
    would be a different one on every machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="strandline-")
    return _LOCAL_SCRATCH[app]


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
