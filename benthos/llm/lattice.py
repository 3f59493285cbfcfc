"""Lattice hashing of embeddings: E8 cells of random rotations, neighbouring cells, exact cosine.

A unit vector is rotated at random and cut into blocks of eight coordinates; a table takes two
blocks, scales them and decodes each to its nearest E8 lattice point.  The home cell is the pair of
points; probes are the next nearest pairs among each block's three nearest points.  Two vectors
meet in a table if the home cell of one is among the cells of the other.  All blocks of a rotation
together hold the whole distance, so some block of close vectors is always close.

Equal vectors are one class with a weight and a number of its own (ids may be null or shared by
different vectors).  Cells of one row are left out before any vector moves.
A pair that meets in several tables or cells counts in the first only (recomputed from the codes of
the linked rows), so link counts are exact sums and no pair is ever emitted: a unit returns a count
for each row and a spanning forest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Stored, ship, stored
from .components import components
from .units import block_pairs, forest, solve, units

TABLES, PROBES, SCALE, SEED, BLOCK = 12, 5, 5.0, 20240617, 512


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8, from their rule."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (integers of even sum)."""
    y = np.rint(x)
    e = x - y
    odd = np.flatnonzero(y.sum(1) % 2)
    k = np.abs(e[odd]).argmax(1)
    y[odd, k] += np.where(e[odd, k] >= 0, 1.0, -1.0)
    return y


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of D8 and D8 shifted by a half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def nearest(x: np.ndarray, n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point and its n - 1 best neighbours, as hashes, and the squared distances."""
    home = decode(x)
    gain = (x - home) @ ROOTS.T
    top = np.argpartition(-gain, n, axis=1)[:, : n - 1]
    points = np.concatenate([home[:, None], home[:, None] + ROOTS[top]], 1)
    return mix((2 * points).astype(np.int64)), ((x[:, None] - points) ** 2).sum(2)


def mix(v: np.ndarray) -> np.ndarray:
    """One 64-bit value for the integers along the last axis."""
    h = np.full(v.shape[:-1], 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(v.shape[-1]):
            h = (h ^ v[..., k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def rotations(dim: int, tables: int) -> list[np.ndarray]:
    width = max(16, -(-dim // 16) * 16)
    rng = np.random.default_rng([SEED, width])
    per = width // 16
    return [np.linalg.qr(rng.normal(size=(width, width)))[0][:dim] for _ in range(-(-tables // per))]


def codes(unit: np.ndarray, turns: list[np.ndarray], tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """(rows, tables, probes) cells of unit vectors, home first."""
    out = np.empty((len(unit), tables, probes), np.int64)
    t = 0
    for q in turns:
        y = unit @ q * (scale * np.sqrt(q.shape[1] / 64))
        for b in range(0, q.shape[1] - 15, 16):
            if t == tables:
                break
            (c0, d0), (c1, d1) = nearest(y[:, b : b + 8]), nearest(y[:, b + 8 : b + 16])
            far = (d0[:, :, None] + d1[:, None, :]).reshape(len(unit), 9)
            far[:, 0] = -1
            pick = np.argsort(far, axis=1, kind="stable")[:, :probes]
            both = mix(np.stack(np.broadcast_arrays(c0[:, :, None], c1[:, None, :]), -1)).reshape(len(unit), 9)
            out[:, t] = np.take_along_axis(both, pick, 1)
            t += 1
    return out


def _rows(body: pd.Series, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, positions, float64 vectors) for each dimension among binary vectors."""
    sizes = body.map(len).to_numpy()
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        x = np.frombuffer(b"".join(body.iloc[at]), kind).astype(np.float64).reshape(len(at), -1)
        yield x.shape[1], at, x


def vectors(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(vec_id, body): the vector as bytes, null if it can't link with anything."""
    kind = "<f4" if "float" in dict(df.dtypes)[vec_col] else "<f8"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for v in b["v"]:
                x = None if v is None else np.array([np.nan if e is None else e for e in v] if getattr(v, "dtype", object) == object else v, dtype=kind)
                out.append(x.tobytes() if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
            yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64"), "body": out})

    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).mapInPandas(run, "vec_id long, body binary"), kind


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Null, empty and zero vectors and those with null or non-finite components link with nothing;
    vectors of different lengths never link; repeated rows link like any equal vectors; a null
    vec_id comes back with a null component, though its vector links like any other; rows that share a
    vec_id but not a vector are vectors of their own; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    made, kind = vectors(df, id_col, vec_col)
    rows = Stored(made, "vec").read()
    classes = stored(rows.where("body is not null").groupBy("body").agg(F.min("vec_id").alias("least"), F.count("*").alias("w")).withColumn("rep", F.monotonically_increasing_id()), "vecclass")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, list] = {}
        for b in batches:
            for dim, at, x in _rows(b["body"], kind):
                if dim not in turns:
                    turns[dim] = rotations(dim, tables)
                norm = np.linalg.norm(x, axis=1, keepdims=True)
                c = codes(x / norm, turns[dim], tables, probes, scale) ^ dim
                n = len(at)
                yield pd.DataFrame({"t": np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), n), "cell": c.ravel(), "rep": np.repeat(b["rep"].to_numpy()[at], tables * probes), "home": np.tile(np.arange(probes) == 0, n * tables)})

    placed = classes.mapInPandas(place, "t int, cell long, rep long, home boolean")
    keys = ["t", "cell"]
    full = units(placed, keys, "rep", BLOCK).join(classes, "rep")

    def work(g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame | None:
        rep, home, blk, left, right, w, t, cell = (g[c].to_numpy() for c in ("rep", "home", "blk", "l", "r", "w", "t", "cell"))
        size = g["body"].map(len).to_numpy()
        unit = np.zeros((len(g), int(size.max()) // int(kind[2])))
        for dim, at, x in _rows(g["body"], kind):
            unit[at, :dim] = x / np.linalg.norm(x, axis=1, keepdims=True)
        i, j, of = [], [], []
        for u, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            for h, o in block_pairs(home[s:e], blk[s:e], left[s], right[s], BLOCK * BLOCK):
                x, y = np.nonzero(unit[s + h] @ unit[s + o].T >= cosine)
                x, y = s + h[x], s + o[y]
                keep = (rep[x] != rep[y]) & (~home[y] | (rep[x] < rep[y])) & (size[x] == size[y])
                i.append(x[keep])
                j.append(y[keep])
                of.append(np.full(int(keep.sum()), u))
        i, j, of = (np.concatenate([*v, np.zeros(0, np.int64)]) for v in (i, j, of))
        if not len(i):
            return None
        rows_at = np.unique(np.concatenate((i, j)))
        cells = np.zeros((len(rows_at), tables, probes), np.int64)
        for dim, at, x in _rows(g["body"].iloc[rows_at], kind):
            cells[at] = codes(x / np.linalg.norm(x, axis=1, keepdims=True), rotations(dim, tables), tables, probes, scale) ^ dim
        first = np.zeros(len(i), bool)
        a, b = np.searchsorted(rows_at, i), np.searchsorted(rows_at, j)
        for c in range(0, len(i), 20_000):
            p = slice(c, c + 20_000)
            ca, cb = cells[a[p]], cells[b[p]]
            meet = (ca[:, :, :1] == cb).any(2) | (cb[:, :, :1] == ca).any(2)
            here = t[i[p]]
            back = (cb[np.arange(len(cb)), here, :1] == ca[np.arange(len(ca)), here]).any(1)  # also met in the other's home cell
            other = cb[np.arange(len(cb)), here, 0]
            first[p] = (meet.argmax(1) == here) & (~back | (cell[i[p]] <= other))
        i, j, of = i[first], j[first], of[first]
        if not len(i):
            return None
        out = []
        ids, inv = np.unique(rep, return_inverse=True)
        n = np.bincount(inv[i], w[j], len(ids)) + np.bincount(inv[j], w[i], len(ids))
        had = np.flatnonzero(n)
        out.append(pd.DataFrame({"a": ids[had], "b": ids[had], "n": n[had].astype(np.int64)}))
        x, y = forest(ids, inv[i], inv[j])
        out.append(pd.DataFrame({"a": x, "b": y, "n": np.zeros(len(x), np.int64)}))
        return pd.concat(out, ignore_index=True)

    found = Stored(solve(full, keys, work, "a long, b long, n long"), "veclinks").read()
    links = found.groupBy("a").agg(F.sum("n").alias("links"))
    comp = components(found.where("a <> b").select("a", "b"), "veccc")
    of = classes.join(links, classes["rep"] == links["a"], "left").join(comp, classes["rep"] == comp["node"], "left").drop("a", "node")
    first = of.where("component is not null").groupBy("component").agg(F.min("least").alias("first")).withColumnRenamed("component", "c")
    of = of.join(first, F.col("component") == F.col("c"), "left")
    of = of.select(F.col("body").alias("k"), (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("first", "least").alias("component_id"))
    out = rows.join(of, rows["body"] == of["k"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("vec_id").isNotNull(), component).alias("component_id"), (F.col("vec_id") == component).alias("kept"))
