"""Structured Streaming forms of the incremental rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from benthos.operators.link import BOX, Linker


def parts(spark: SparkSession, root: str, schema, glob: str = "*.parquet", per_batch: int = 100) -> DataFrame:
    """Report parts as they appear under a folder; a checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_batch).parquet(root)


def sessions(stream: DataFrame, at: str, gap: str, late: str, keys: list[str] | None = None) -> DataFrame:
    """(keys, start, stop, points): stretches with no silence over `gap`; rows later than `late` are left out."""
    g = stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), *(keys or []))
    return g.agg(F.min(at).alias("start"), F.max(at).alias("stop"), F.count("*").alias("points")).drop("w")


def buckets(stream: DataFrame, at: str, width: str, late: str, keys: list[str], value: str) -> DataFrame:
    """(keys, bucket, animals, slices) in tumbling windows."""
    g = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *keys)
    return g.agg(F.sum(value).alias("animals"), F.count("*").alias("slices")).select(*keys, F.col("w.start").alias("bucket"), "animals", "slices")


def first_seen(stream: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Each key's first row within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def tracked(stream: DataFrame, gap: float, idle_ms: int | None = None) -> DataFrame:
    """sightings with `animal`: the batch tracker with a fixed gap, holding only open tracks as state.

    Moments of one recording must arrive in order.  With `idle_ms` a recording leaves the state that long after
    its last batch; a query with such a time-out never runs dry, so leave it out under availableNow.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema) + ", animal long"
    state = "next long, ids array<long>, last array<double>, boxes array<double>, taxa array<string>"

    def step(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        linker = Linker(gap)
        if held.exists:
            n, ids, last, boxes, taxa = held.get
            linker.next, linker.ids, linker.last = n, np.array(ids, np.int64), np.array(last, float)
            linker.boxes, linker.taxa = np.array(boxes, float).reshape(-1, 4), np.array(list(taxa), object)
        g = pd.concat(list(batches)).sort_values(["second", "confidence", "ord"], ascending=[True, False, True], kind="stable").reset_index(drop=True)
        ids = []
        for second, m in g.groupby("second", sort=True):
            ids += linker.moment(float(second), m[BOX].to_numpy(float), m["taxon"].tolist())
        held.update((linker.next, linker.ids.tolist(), linker.last.tolist(), linker.boxes.ravel().tolist(), linker.taxa.tolist()))
        if idle_ms:
            held.setTimeoutDuration(idle_ms)
        yield g.assign(animal=ids)

    return stream.groupBy("recording").applyInPandasWithState(step, schema, state, "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Everything that is there now, through memory, for tests and small results."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
