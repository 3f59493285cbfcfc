"""Near copies by five-word Jaccard similarity: SimHash finds the candidates, exact sets decide.

1. Each text is its set of SIZE-word shingles (64-bit hashes); texts of one set are one class.
2. A class's fingerprint is the SimHash of its distinct FEATURE-word shingles: few words of an edit
   touch few of them, so near copies differ in few bits.
3. The generalised pigeonhole of `simhash` (correlated parts, thresholds by dynamic programming, probe,
   verify) finds every pair of classes within TAU bits; pairs whose set sizes can't reach LEAST go.
   A pair counts in the first part in which it meets, so once.
4. Only classes that met another one are given their sets; a unit of rows takes the exact
   similarity of all its pairs at once and returns a spanning forest of its links, never the pairs.
5. Components by star contraction.

Every link is exact.  A pair of LEAST similarity or more is missed only if its fingerprints differ in
more than TAU bits; README has the measured share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import BROADCAST_IDS, Stored, ship, stored, text_hash
from .components import components
from .simhash import fingerprint, plan, probes
from .units import block_pairs, forest, solve, units

SIZE, FEATURE, TAU = 5, 2, 13
#: Least similarity of a link, as a fraction.
LEAST = (4, 5)
#: Rows of one key handled together as fingerprints, and with their sets.
BLOCK, SET_BLOCK = 65_536, 512
#: Numbers of parts to choose from, and the cost of a probe against that of comparing two fingerprints.
PARTS, PROBE = (4, 5, 6, 7, 8), 100.0
#: Fingerprints compared at once: so many home rows with so many others.
STEP, ROOM = 64, 16_384
#: Shingles of a unit that are matched at once.
COLUMNS = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _fold(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h ^ more) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes, ascending; a shorter text is one shingle, a wordless one has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(SIZE, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = _fold(h, w[i : i + len(h)])
    return np.unique(h)


def class_of(s: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64))


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for i in range(0, len(b), 1000):
            yield b.iloc[i : i + 1000]


def _prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in _slices(batches):
        sets = [shingles(t) for t in b["text"]]
        fps = np.fromiter((fingerprint(t, FEATURE, True) for t in b["text"]), np.uint64, len(b))
        yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").array, "text_hash": b["text_hash"].array, "cls": [class_of(s) for s in sets], "n": [len(s) for s in sets], "fp": fps.view(np.int64)})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in _slices(batches):
        sets = [shingles(t) for t in b["text"]]
        yield pd.DataFrame({"rep": [class_of(s) for s in sets], "s": [s.tobytes() for s in sets]})


class Search:
    """Which rows of a unit are candidates, for given parts and thresholds."""

    def __init__(self, parts: list[list[int]], ts: list[int]):
        self.used = [(i, np.uint64(sum(1 << b for b in part)), t) for i, (part, t) in enumerate(zip(parts, ts, strict=True)) if t >= 0]

    def pairs(self, g: pd.DataFrame, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (from s) of the unit's pairs within TAU bits whose sizes may reach LEAST, the lesser id at home."""
        fp, rep, n, home, blk = (g[c].to_numpy()[s:e] for c in ("fp", "rep", "n", "home", "blk"))
        fp, part, left, right = fp.view(np.uint64), int(g["part"].iat[s]), int(g["l"].iat[s]), int(g["r"].iat[s])
        i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for h, o in self.sized(n, home, blk, left, right):
            x, y = np.nonzero(np.bitwise_count(fp[h, None] ^ fp[None, o]) <= TAU)
            x, y = h[x], o[y]
            keep = (rep[x] < rep[y]) & (np.minimum(n[x], n[y]) * LEAST[1] >= np.maximum(n[x], n[y]) * LEAST[0])
            for p, mask, t in self.used:
                if p < part:  # met there already
                    keep &= np.bitwise_count((fp[x] ^ fp[y]) & mask) > t
            i.append(x[keep])
            j.append(y[keep])
        return np.concatenate(i), np.concatenate(j)

    @staticmethod
    def sized(n: np.ndarray, home: np.ndarray, blk: np.ndarray, left: int, right: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Home rows in steps of like sizes, and the rows whose sizes are near enough."""
        for h, o in block_pairs(home, blk, left, right, 1 << 40):
            h, o = h[np.argsort(n[h], kind="stable")], o[np.argsort(n[o], kind="stable")]
            sizes = n[o]
            for c in range(0, len(h), STEP):
                at = h[c : c + STEP]
                first, last = np.searchsorted(sizes, (n[at[0]] * LEAST[0] // LEAST[1], -(-n[at[-1]] * LEAST[1] // LEAST[0]) + 1))
                for k in range(first, last, ROOM):
                    yield at, o[k : min(k + ROOM, last)]

    def met(self, g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame | None:
        """The rows that are in any pair."""
        at = [s + np.unique(np.concatenate(self.pairs(g, s, e))) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        rows = np.concatenate(at)
        return g.iloc[rows][["part", "key", "rep", "fp", "n", "home"]] if len(rows) else None

    def linked(self, g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame | None:
        """A spanning forest of the links."""
        out = []
        rep, n = g["rep"].to_numpy(), g["n"].to_numpy()
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            i, j = self.pairs(g, s, e)
            if not len(i):
                continue
            rows = np.unique(np.concatenate((i, j)))
            both = shared([np.frombuffer(b, np.uint64) for b in g["s"].iloc[s + rows]])[np.searchsorted(rows, i), np.searchsorted(rows, j)]
            near = both * LEAST[1] >= (n[s + i] + n[s + j] - both) * LEAST[0]
            ids, inv = np.unique(rep[s:e], return_inverse=True)
            a, b = forest(ids, inv[i[near]], inv[j[near]])
            out.append(pd.DataFrame({"a": a, "b": b}))
        return pd.concat(out, ignore_index=True) if out else None


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets share."""
    all_of = np.concatenate(sets)
    _, col, times = np.unique(all_of, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = times > 1
    col, row = (np.cumsum(often) - 1)[col[often[col]]], row[often[col]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    for c in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(col, (c, c + COLUMNS))
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[row[a:b], col[a:b] - c] = 1
        out += (m @ m.T).astype(np.int64)  # at most COLUMNS, exact in float32
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, group_id, component_id) of every row; component_id is the least doc_id of the group.

    Null and wordless texts are one class; repeated rows come back as often as they went in; a null
    doc_id comes back with the component of its class; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = Stored(src.withColumn("text_hash", text_hash("text")).mapInPandas(_prints, "doc_id long, text_hash long, cls long, n long, fp long"), "jac").read()
    reps = stored(prints.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("fp").alias("fp")), "jacreps")

    seek = reps.where("n > 0").select("fp", F.col("cls").alias("rep"), "n")
    layout = plan(seek, TAU, PARTS, PROBE)
    search, keys = Search(*layout), ["part", "key"]
    rows = "part int, key long, rep long, fp long, n long, home boolean"
    met = stored(solve(units(probes(seek, *layout), keys, "rep", BLOCK), keys, search.met, rows).distinct(), "jacmet")

    wanted = stored(met.select("rep").distinct(), "jacwant")
    ids = stored(wanted.join(reps.select("cls", F.col("rep").alias("_id")), F.col("rep") == F.col("cls")).select("_id").distinct(), "jacids")
    texts = src.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = stored(texts.mapInPandas(_sets, "rep long, s binary").join(wanted, "rep", "left_semi").dropDuplicates(["rep"]), "jacsets")
    linked = stored(solve(units(met, keys, "rep", SET_BLOCK).join(sets, "rep"), keys, search.linked, "a long, b long"), "jaclinks")
    comp = stored(components(linked, "jaccc"), "jaccomp")

    least = comp.join(reps, F.col("node") == F.col("cls")).groupBy("component").agg(F.min("rep").alias("least"))
    group = comp.join(least, "component").select("node", "component", "least")
    of = reps.join(group, F.col("cls") == F.col("node"), "left").select(F.col("cls").alias("c"), F.coalesce("component", "cls").alias("group_id"), F.coalesce("least", "rep").alias("component_id"))
    return prints.select("doc_id", "text_hash", "cls").join(of, F.col("cls") == F.col("c"), "left").select("doc_id", "text_hash", "group_id", "component_id")
