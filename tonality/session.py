"""Session helpers.

``local_session`` is for tests and the benchmark only; library functions
never build a session and read what they need from the one they are given.
"""

from __future__ import annotations

import os
import posixpath
import tempfile

from pyspark.sql import SparkSession

_FALLBACK_DIR: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tonality", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way the library expects.

    ``event_log_dir`` turns on Spark's event log there (stage and task times
    for offline reading; the web UI stays off)."""
    scratch = tempfile.mkdtemp(prefix="tonality-run-")
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.tonality.spreadTo", str(shuffle_partitions))   # test tables are one row group each
        .config("spark.driver.memory", os.environ.get("TONALITY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", posixpath.join(scratch, "warehouse"))
        .config("spark.local.dir", posixpath.join(scratch, "local"))
        .config("spark.checkpoint.dir", posixpath.join(scratch, "checkpoint"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    Written tables (run log, stages, stream checkpoints, saved models) go
    here.  The location is read from the session (``spark.checkpoint.dir``
    or the context's checkpoint dir).  Only when neither is set in a local
    session - a test - a temporary folder is created and registered as the
    checkpoint dir, so later calls agree; on a cluster that is an error, as
    executors do not share such a folder.
    """
    global _FALLBACK_DIR
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured and not current:
        sc.setCheckpointDir(configured)      # named by the cluster: make checkpoint() use it
    base = configured or current
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _FALLBACK_DIR is None:
            _FALLBACK_DIR = tempfile.mkdtemp(prefix="tonality-ckpt-")
        sc.setCheckpointDir(_FALLBACK_DIR)
        base = _FALLBACK_DIR
    return posixpath.join(base, "tonality", *parts)
