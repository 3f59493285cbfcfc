"""Shared plumbing: materialised tables in the cluster's shared folder, worker paths, tables."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_LEFT: list = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input table `name`, read by Spark's own reader."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Python workers live on from task to task, so they give large blocks back at once.
_WORKERS = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "2097152", "MALLOC_TRIM_THRESHOLD_": "16777216", "ARROW_DEFAULT_MEMORY_POOL": "system"}
#: Spark's setting for the bytes of an Arrow batch, its default, and what long texts get here.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, in bounded memory."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = ":".join([_ROOT, *parts])
    for k, v in _WORKERS.items():
        env.setdefault(k, v)
    if spark.conf.get(_BATCH[0], _BATCH[1]) == _BATCH[1]:
        spark.conf.set(_BATCH[0], _BATCH[2])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where there is only this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(where or f"file://{tempfile.mkdtemp(prefix='benthos-')}")
    return sc.getCheckpointDir()


class Stored:
    """A table written once to the shared folder; reading it starts a new, short lineage."""

    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/benthos-{tag}-{uuid.uuid4().hex}"
        self.schema = df.schema
        df.write.parquet(self.path)
        _LEFT.append(self)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        if self in _LEFT:
            _LEFT.remove(self)
            sc = self.spark.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` to the shared folder and read it back (lineage cut that outlives executors)."""
    return Stored(df, tag).read()


#: Rows' keys that may be broadcast: 16 bytes each.
BROADCAST_IDS = 2_000_000


def text_hash(text_col: str = "text") -> Column:
    """With the id, what a decision about a row is keyed by: rows may share an id, or have none."""
    return F.xxhash64(F.col(text_col).cast("string"))


def keyed(docs: DataFrame, keys: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs joined (left_anti, left_semi) to keys (id, text hash); a null id equals a null id.

    The keys are broadcast while they are few (counted first), so texts stay where they are; beyond
    that the join shuffles.
    """
    k = stored(keys.toDF("__id", "__hash").distinct(), "keys")
    return docs.join(F.broadcast(k) if k.count() <= BROADCAST_IDS else k, F.col(id_col).eqNullSafe(F.col("__id")) & (text_hash(text_col) == F.col("__hash")), how)


@atexit.register
def _sweep() -> None:
    for s in list(_LEFT):
        try:
            s.drop()
        except Exception:  # noqa: BLE001  the session may be gone already
            return
