"""Session helpers shared by the bench, the tests and the streaming code."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, name: str = "logloom", partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # no call-site capture per column call: plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


#: The folder of this process where no shared one is set, on a local master only.
_LOCAL_DIR: str | None = None


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared folder ``spark.checkpoint.dir``.

    Without that setting a local master uses one temporary folder of this process; the session is not changed. On a
    cluster that would lose rows without an error, so it is refused there.
    """
    global _LOCAL_DIR
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _LOCAL_DIR = _LOCAL_DIR or tempfile.mkdtemp(prefix="logloom-")
        root = _LOCAL_DIR
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df, spark: SparkSession, purpose: str):
    """Write ``df`` to the shared folder and read it back.

    The written table survives the loss of executors, unlike blocks kept on them.
    """
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
