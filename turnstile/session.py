"""Session settings of the jobs, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Call sites of every column expression, which large plans pay for on each build.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and handed-over tables: ``spark.checkpoint.dir``.

    Where none is named and all tasks run in this process (tests, one machine),
    a fresh local folder is set for this session.  On a cluster executors would
    not share such a folder, so a missing setting raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
    folder = tempfile.mkdtemp(prefix="turnstile-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
