"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames. ``local_session`` is for tests, the bench and the examples;
on a cluster use the session the platform hands you and keep its settings.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry. They are semantic (time zone) or
# scale-related (AQE re-plans joins and coalesces small shuffles at run time,
# skew join splits hot partitions).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Halo blocks hold 4,096 + 167 rows; keep a block in the window operator's
    # in-memory buffer instead of its spillable fallback (default 4,096 rows).
    "spark.sql.windowExec.buffer.in.memory.threshold": "16384",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", scratch: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks.

    ``scratch`` holds the warehouse, and the checkpoint folder when the
    environment names none in ``spark.checkpoint.dir``; a fresh temp folder is
    used when omitted. The Spark UI stays off.
    """
    scratch = scratch or tempfile.mkdtemp(prefix="tidemark-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
    )
    if os.environ.get("TIDEMARK_EVENT_LOG"):
        # Stage and task times for profiling, written to the scratch folder.
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
        builder = (builder.config("spark.eventLog.enabled", "true")
                          .config("spark.eventLog.dir", os.path.join(scratch, "events")))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    # Locally the shuffle partitions already equal the cores; coalescing them
    # by bytes would leave window-heavy (CPU-bound, byte-light) stages on one
    # or two cores.
    builder = builder.config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, scratch)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL defaults on an existing session (cluster use)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, scratch: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local session without one (tests) gets a folder under
    ``scratch``; a session over several machines without one is refused,
    since each executor would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = os.path.join(scratch or tempfile.mkdtemp(prefix="tidemark-"),
                                  "checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
