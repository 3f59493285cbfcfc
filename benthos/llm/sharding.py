"""Longest-processing-time sharding of groups that must stay together.

Groups are sized by a partial aggregate and put into size classes of eleven significant bits (at
most about 110,000 classes at any scale; below 4,096 bytes each size is its own class).  The
driver runs the heap over classes, largest first: all of a class's groups are levelled onto the
least-loaded shards at once and what remains goes through the heap.  Groups find their shard by
their rank in their class.  Ranks and slots are numbered in two levels (chunk counts, running
offsets, row numbers inside a chunk), so no shard and no class is ever one task.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Stored, stored

#: Rows that one chunk of the two-level numbering holds on average.
CHUNK = 20_000


def level(loads: np.ndarray, size: float, n: int) -> np.ndarray:
    """How many of n items of one size each shard gets when every item goes to the least loaded."""
    lo, hi = float(loads.min()), float(loads.max()) + size * (n + 1)
    for _ in range(80):
        mid = (lo + hi) / 2
        if np.floor(np.maximum(0, mid - loads) / size).sum() <= n:
            lo = mid
        else:
            hi = mid
    got = np.floor(np.maximum(0, lo - loads) / size).astype(np.int64)
    heap = [(float(loads[i] + got[i] * size), i) for i in range(len(loads))]
    heapq.heapify(heap)
    for _ in range(n - int(got.sum())):
        load, i = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (load + size, i))
    return got


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(class, groups, bytes) -> (class, running ends of the ranks that each shard takes)."""
    loads, out = np.zeros(shards), []
    for cls, n, total in sorted(classes, reverse=True):
        got = level(loads, total / n, n)
        loads += got * (total / n)
        out.append((cls, np.cumsum(got).tolist()))
    return out


def numbered(df: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within each value of `by`, whatever that value's share of the rows."""
    chunks = max(1, -(-df.count() // CHUNK))
    df = df.withColumn("_c", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    before = df.groupBy(by, "_c").count().select(F.col(by).alias("_b"), F.col("_c").alias("_d"), (F.sum("count").over(Window.partitionBy(by).orderBy("_c")) - F.col("count")).alias("_o"))
    inside = df.withColumn("_n", F.row_number().over(Window.partitionBy(by, "_c").orderBy(*order)).cast("long"))
    joined = inside.join(before, (inside[by] == before["_b"]) & (inside["_c"] == before["_d"]))
    return joined.withColumn(name, F.col("_n") - 1 + F.col("_o")).drop("_c", "_n", "_b", "_d", "_o")


def assign(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, text_sha256, shard, slot) of every row.

    A null text has no bytes and groups with empty ones; rows of equal text share a shard, repeated
    rows too; a null doc_id stays null; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = Stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("g")), "rows").read()
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes"))
    spare = F.greatest(F.lit(0), F.length(F.bin("bytes")) - 12)
    groups = stored(groups.withColumn("cls", F.call_function("shiftleft", F.call_function("shiftright", F.col("bytes"), spare), spare)), "groups")
    classes = [(r["cls"], r["n"], r["t"]) for r in groups.groupBy("cls").agg(F.count("*").alias("n"), F.sum("bytes").alias("t")).collect()]
    ends = rows.sparkSession.createDataFrame(schedule(classes, shards), "k long, ends array<long>")
    ranked = numbered(groups.select("g", "cls"), "cls", ["g"], "rank")
    placed = ranked.join(F.broadcast(ends), ranked["cls"] == ends["k"]).select(F.col("g").alias("h"), F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"))
    out = rows.join(placed, rows["g"] == placed["h"]).select("doc_id", "size", "text_crc32", F.col("g").alias("text_sha256"), "shard")
    return numbered(stored(out, "placed"), "shard", ["doc_id", "text_sha256"], "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows themselves as path/shard=N; rows of equal text go together; a `shard` column of their own is replaced."""
    to = assign(docs, shards, id_col, text_col).select(F.col("text_sha256").alias("__h"), F.col("shard").alias("__s")).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.drop("shard").withColumn("__g", F.unhex(F.sha2(text.cast("binary"), 256))).join(to, F.col("__g") == F.col("__h"))
    joined.drop("__g", "__h").withColumnRenamed("__s", "shard").write.partitionBy("shard").parquet(path)
