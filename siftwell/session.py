"""Session settings, and the shared folder that long jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Into how many partitions texts are dealt before per-row work. Unset, and so on a cluster, they stay where they lie.
INPUT_PARTITIONS = "siftwell.input.partitions"


def build_session(app: str = "siftwell", cores: int | None = None) -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the session it hands out."""
    master = f"local[{cores}]" if cores else "local[*]"
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(INPUT_PARTITIONS, str(cores or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where neither that nor a checkpoint
    directory is set, and the session is a local one, is one made, on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="siftwell-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
