"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "signalbook", cores: str = "8") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SIGNALBOOK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in
    ``spark.checkpoint.dir``.

    Only a single-machine session may go without the setting; it then gets a
    fresh temporary folder.  A cluster session without it is an error, as a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="signalbook-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def new_dir(spark: SparkSession, name: str) -> str:
    """A path for one run inside the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """``df`` computed once and cut from its lineage, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
