"""Where a collection's inputs lie: parts or merged reports, truth candidates, deployments, frame containers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from benthos.operators.joins import interval_first

from .parts import read_parts


def _files(spark: SparkSession, path: str) -> list[str]:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def expedition(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An expedition's rows: its parts where it has any, else its merged report; names that begin with _ are left out."""
    have = [f for f in _files(spark, f"{root}/{name}/parts") if f.endswith(".parquet") and not f.startswith("_")]
    return read_parts(spark, f"{root}/{name}/parts") if have else spark.read.parquet(f"{root}/{name}.parquet")


def first_answer(spark: SparkSession, candidates: list[str]) -> DataFrame | None:
    """Lines of the first candidate that exists, or None."""
    for c in candidates:
        folder, _, name = c.rpartition("/")
        if name in _files(spark, folder):
            return spark.read.text(c)
    return None


def deployments(register: DataFrame) -> DataFrame:
    """(ref, no, start, stop, latitude, longitude, depth_m) of a deployment register; rows without a place are left out."""
    t = lambda c: F.nullif(F.trim(c), F.lit("")).try_cast("timestamp_ntz")
    n = lambda c: F.trim(c).try_cast("double")
    x = register.select(F.trim("Reference Designator").alias("ref"), F.col("deploymentNumber").try_cast("int").alias("no"), t("startDateTime").alias("start"), t("stopDateTime").alias("stop"), n("lat").alias("latitude"), n("lon").alias("longitude"), n("deployment_depth").alias("depth_m"))
    return x.dropna(subset=["ref", "start", "latitude", "longitude"])


def deployed(recordings: DataFrame, register: DataFrame) -> DataFrame:
    """recordings (name, ref, recorded_at) with the first deployment that covers them."""
    return interval_first(recordings, deployments(register), "recorded_at", "start", "stop", ["no"], ["name"], ["ref"])


class _Range(InputPartition):
    def __init__(self, start: int, stop: int):
        super().__init__((start, stop))
        self.start, self.stop = start, stop


class Frames(DataSource):
    """format("frames"): planes of a container, a row each, split into ranges; planes that can't be read are passed over.

    The container here is a .npy stack (no video codec is installed) in a folder that executors can open.
    """

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "frame long, height int, width int, plane binary"

    def reader(self, schema) -> DataSourceReader:
        return _FramesReader(self.options)


class _FramesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.step = options["path"], int(options.get("framesperpartition", options.get("framesPerPartition", 256)))

    def partitions(self) -> list[InputPartition]:
        import numpy as np

        n = np.load(self.path, mmap_mode="r").shape[0]
        return [_Range(s, min(n, s + self.step)) for s in range(0, n, self.step)]

    def read(self, part: _Range) -> Iterator[tuple]:
        import numpy as np

        stack = np.load(self.path, mmap_mode="r")
        for i in range(part.start, part.stop):
            plane = np.asarray(stack[i], np.float32)
            if np.isfinite(plane).all():
                yield i, int(plane.shape[0]), int(plane.shape[1]), plane.tobytes()
