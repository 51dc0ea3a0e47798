"""Session settings and the shared folder used for checkpoints and hand-off tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on for speed, never for results. A cluster keeps its own
# shuffle partition count; AQE coalesces small partitions and splits skewed ones.
SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "signalstar") -> SparkSession:
    """A local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SIGNALSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets one folder for the whole session, since there
    the driver's own disk is shared with all tasks. On a cluster a missing setting is an
    error rather than a silent write to one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="signalstar-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, so that no two runs meet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
