"""Groups in few Python calls: partitions sorted by key, streamed batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame

#: Partitions, at least, of groups that take long: few of them then share a task.
SPREAD = 96


def stream_groups(df: DataFrame, keys: list[str], order: list[Column | str], work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """work(rows of whole groups in order, their bounds) over all groups; one group and one batch are held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def bounds(g: pd.DataFrame) -> np.ndarray:
            cut = np.zeros(len(g) - 1, bool)
            for k in keys:
                v = g[k].to_numpy()
                cut |= (v[1:] != v[:-1]) & ~(pd.isna(v[1:]) & pd.isna(v[:-1]))
            return np.concatenate(([0], np.flatnonzero(cut) + 1, [len(g)]))

        for b in batches:
            if not len(b):
                continue
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            at = bounds(b)
            held = b.iloc[at[-2] :].reset_index(drop=True)
            if len(at) > 2:
                yield work(b.iloc[: at[-2]], at[:-1])
        if held is not None:
            yield work(held, np.array([0, len(held)]))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


class Scan(Protocol):
    """What follows one group's rows in order; either method may return None."""

    def feed(self, rows: pd.DataFrame) -> pd.DataFrame | None: ...

    def end(self) -> pd.DataFrame | None: ...


def scan_groups(df: DataFrame, keys: list[str], order: list[Column | str], whole: list[str], make: Callable[[pd.DataFrame], Scan], schema: str) -> DataFrame:
    """Feed every group's rows in order to its own make(first rows), batch by batch: no group is ever held.

    Rows that are also equal in `whole` (sorted right after the keys) arrive in one piece.
    """

    def cuts(g: pd.DataFrame, names: list[str]) -> np.ndarray:
        cut = np.zeros(max(0, len(g) - 1), bool)
        for k in names:
            v = g[k].to_numpy()
            at = np.flatnonzero(v[1:] != v[:-1])
            cut[at[~(pd.isna(v[at + 1]) & pd.isna(v[at]))]] = True
        return np.concatenate(([0], np.flatnonzero(cut) + 1, [len(g)]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan, now, held = None, None, None

        def pieces(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
            nonlocal scan, now
            at = cuts(g, keys)
            for s, e in zip(at[:-1], at[1:], strict=True):
                part = g.iloc[s:e].reset_index(drop=True)
                key = tuple(None if pd.isna(v) else v for v in part.loc[0, keys])
                if scan is None or key != now:
                    if scan is not None and (out := scan.end()) is not None:
                        yield out
                    scan, now = make(part), key
                if (out := scan.feed(part)) is not None:
                    yield out

        for b in batches:
            if not len(b):
                continue
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            last = cuts(b, [*keys, *whole])[-2]
            held = b.iloc[last:]
            if last and (out := list(pieces(b.iloc[:last]))):
                yield pd.concat(out, ignore_index=True)
        if held is not None:
            out = list(pieces(held))
            if (rest := scan.end()) is not None:
                out.append(rest)
            if out:
                yield pd.concat(out, ignore_index=True)

    return df.repartition(*keys).sortWithinPartitions(*keys, *whole, *order).mapInPandas(run, schema)


def _changes(t: pa.Table, names: list[str]) -> np.ndarray:
    """Whether each row but the first differs from the one before it; nulls are alike."""
    cut = np.zeros(max(0, len(t) - 1), bool)
    for k in names:
        a, b = t[k].slice(0, len(cut)), t[k].slice(1)
        if pa.types.is_floating(t.schema.field(k).type):
            a, b = a.to_numpy(), b.to_numpy()
            cut |= (a != b) & ~(np.isnan(a) & np.isnan(b))
        else:
            cut |= pc.coalesce(pc.not_equal(a, b), pc.xor(a.is_null(), b.is_null())).to_numpy()
    return cut


class ArrowScan(Protocol):
    """What follows one group's rows in order."""

    def feed(self, rows: pa.Table) -> pa.Table: ...


def scan_tables(df: DataFrame, keys: list[str], order: list[Column | str], whole: list[str], columns: list[str], make: Callable[[pa.Table], ArrowScan], schema: str) -> DataFrame:
    """scan_groups for groups that take long, on Arrow tables of `columns` only: what just orders rows isn't sent.

    Groups are dealt over SPREAD partitions at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, now, held = None, None, None

        def pieces(t: pa.Table, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal scan, now
            at = [0, *(np.flatnonzero(cut) + 1).tolist(), len(t)]
            for s, e in zip(at[:-1], at[1:], strict=True):
                part = t.slice(s, e - s)
                key = tuple(None if v != v else v for v in (part[k][0].as_py() for k in keys))
                if scan is None or key != now:
                    scan, now = make(part), key
                yield from scan.feed(part).to_batches()

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b]).combine_chunks()
            cut = _changes(t, keys)
            at = np.flatnonzero(cut | _changes(t, whole))
            last = int(at[-1]) + 1 if len(at) else 0
            held = t.slice(last)
            if last:
                yield from pieces(t.slice(0, last), cut[: last - 1])
        if held is not None:
            yield from pieces(held, _changes(held, keys))

    spread = max(SPREAD, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(spread, *keys).sortWithinPartitions(*keys, *whole, *order).select(*columns).mapInArrow(run, schema)
