"""What a session needs besides Spark: the folder that all executors share, and this package on workers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; one of our own only where there is no other machine, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not where and sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir: executors have folders of their own")
        sc.setCheckpointDir(where or f"file://{tempfile.mkdtemp(prefix='benthos-')}")
    return sc.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (a cluster gets it by --py-files or an image)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in parts:
        env["PYTHONPATH"] = ":".join([root, *parts])
