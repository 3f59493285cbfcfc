"""Work on all pairs inside a key without ever holding an unbounded group.

Rows are (key columns, id, home, ...).  Keys with at least two rows and one home row are kept; a
key of more than `block` rows is split into blocks and every pair of blocks is a unit of its own.
Units are streamed from sorted partitions, so a task holds one unit and one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def units(placed: DataFrame, keys: list[str], id_col: str, block: int) -> DataFrame:
    """placed -> its rows in crowded keys, with blk and the unit's pair of blocks (l <= r)."""
    crowded = placed.groupBy(*keys).agg(F.count("*").alias("n"), F.max("home").alias("some")).where("n > 1 and some").select(*keys, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    return (
        placed.join(crowded, keys)
        .withColumn("blk", F.pmod(F.xxhash64(id_col), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("l", F.least("blk", "other"))
        .withColumn("r", F.greatest("blk", "other"))
        .drop("blocks", "other")
    )


def solve(df: DataFrame, keys: list[str], work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame | None], schema: str) -> DataFrame:
    """work(rows of whole units, their bounds) for all units, each unit in one piece."""
    order = [*keys, "l", "r"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def bounds(g: pd.DataFrame) -> np.ndarray:
            cut = np.zeros(len(g) - 1, bool)
            for c in order:
                v = g[c].to_numpy()
                cut |= v[1:] != v[:-1]
            return np.concatenate(([0], np.flatnonzero(cut) + 1, [len(g)]))

        for b in batches:
            if not len(b):
                continue
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            start = bounds(b)[-2]
            held = b.iloc[start:]
            if start:
                whole = b.iloc[:start]
                if (done := work(whole, bounds(whole))) is not None:
                    yield done
        if held is not None and (done := work(held, bounds(held))) is not None:
            yield done

    return df.repartition(*order).sortWithinPartitions(*order).mapInPandas(run, schema)


def forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked row to the least row of its local component; ids ascending."""
    lab = np.arange(len(ids))
    while True:
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, lab[i], low)
        np.minimum.at(new, lab[j], low)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    at = np.flatnonzero(lab != np.arange(len(ids)))
    return ids[at], ids[lab[at]]


def block_pairs(home: np.ndarray, blk: np.ndarray, left: int, right: int, room: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs to compare in a unit: home rows of one block against the other block's rows, `room` pairs at once."""
    for a, b in {(left, right), (right, left)}:
        h, o = np.flatnonzero(home & (blk == a)), np.flatnonzero(blk == b)
        step = max(1, room // max(1, len(o)))
        for c in range(0, len(h), step):
            yield h[c : c + step], o
