"""SimHash near-duplicates, linked exactly by the generalised pigeonhole principle.

1. Fingerprint every whole text (64 bits, majority of shingle hashes).
2. Keep one representative (least doc_id) per distinct fingerprint.
3. Group correlated bits into m parts; per-part thresholds t_i with sum t_i = tau - m + 1 are
   allocated by dynamic programming on candidate counts estimated from all fingerprints.  Any pair
   within tau bits agrees to within t_i bits on some part i, so probing each part's key ball of
   radius t_i and verifying finds every link.
4. Crowded keys are split into blocks and each pair of blocks is its own unit of work, so no task
   holds an unbounded group; each unit returns a spanning forest of its links, never all pairs.
5. Components by star contraction.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Stored, ship, stored
from .components import components
from .units import block_pairs, forest, solve, units

BITS = 64
#: Rows of one key handled together; larger keys are split into blocks of about this size.
BLOCK = 1024


def fingerprint(text: str | None, size: int = 3, distinct: bool = False) -> int:
    """Unsigned 64-bit SimHash of a whole text's shingles (repeats included, or `distinct`); 0 if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - size + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(size, len(words)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    return majority(np.unique(h) if distinct else h)


_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    octets = h.view(np.uint8).reshape(-1, 8)
    if len(h) < 64:
        counts = np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _OF_BYTE for i in range(8)])
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(doc_id, fp long): the 64 bits as a signed long. One narrow pass, no shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, size) for t in b["text"]), np.uint64, len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fps.view(np.int64)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, fp long")


# --- planning ---------------------------------------------------------------------------------


def _gram(reps: DataFrame) -> tuple[int, np.ndarray]:
    """How often each pair of bits is set together, over all distinct fingerprints."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = np.unpackbits(b["fp"].to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += x.T @ x
            n += len(x)
        yield pd.DataFrame({"i": np.append(np.arange(BITS * BITS), -1), "n": np.append(total.ravel(), n).astype(np.int64)})

    got = reps.select("fp").mapInPandas(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()  # 4,097 rows
    by = dict(zip(got["i"], got["n"], strict=True))
    return int(by.get(-1, 0)), np.array([by.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, gram: np.ndarray, m: int) -> list[list[int]]:
    """m parts of near-equal width: each seed takes the unused bits most correlated with its part."""
    p = np.diag(gram) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(gram / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    free, parts = set(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        left = sorted(free)
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        free.discard(part[0])
        while len(part) < width:
            nxt = max(sorted(free), key=lambda b: (corr[b, part].sum(), -b))
            part.append(nxt)
            free.discard(nxt)
        parts.append(sorted(part))
    return parts


def _within(p: np.ndarray, t: int) -> float:
    """P(two independent draws differ in at most t of these bits)."""
    dist = np.array([1.0])
    for q in 2 * p * (1 - p):
        dist = np.append(dist, 0) * (1 - q) + np.append(0, dist) * q
    return float(dist[: t + 1].sum())


def _ball(width: int, t: int) -> int:
    return sum(_choose(width, k) for k in range(t + 1))


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


#: Cost of one probe row that is shuffled and sorted, against one candidate that is verified.
PROBE_COST = 20.0


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds with the given sum and the least cost, by dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (v, ts) in best.items():
            for t, w in c.items():
                if s + t not in step or v + w < step[s + t][0]:
                    step[s + t] = (v + w, [*ts, t])
        best = step
    return best[total]


def key_of(col, bits: list[int]):
    """These bits of a long as a compact key, with runs of neighbouring bits moved at once."""
    out, at = F.lit(0).cast("long"), 0
    for _, run in itertools.groupby(enumerate(bits), lambda x: x[1] - x[0]):
        run = [b for _, b in run]
        piece = F.shiftrightunsigned(col, run[0]).bitwiseAND(F.lit((1 << len(run)) - 1 if len(run) < 64 else -1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(piece, at))
        at += len(run)
    return out


def plan(reps: DataFrame, tau: int, choices: tuple[int, ...] = (2, 3, 4), probe_cost: float = PROBE_COST) -> tuple[list[list[int]], list[int]]:
    """Parts and thresholds of least estimated cost, from statistics of all fingerprints."""
    n, gram = _gram(reps)
    p = np.diag(gram) / max(n, 1)
    layouts = {m: group_bits(n, gram, m) for m in choices if m <= tau + 1}
    every = [(m, i, part) for m, parts in layouts.items() for i, part in enumerate(parts)]
    keys = reps.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), key_of(F.col("fp"), part).alias("k")) for j, (_, _, part) in enumerate(every)])).alias("x"))
    same = keys.groupBy("x.j", "x.k").count().groupBy("j").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("s")).collect()  # a row for each part
    pairs = {r["j"]: r["s"] for r in same}
    best = None
    for m, parts in layouts.items():
        costs = []
        for j, (mm, _, part) in enumerate(every):
            if mm == m:
                at_zero = max(_within(p[part], 0), 1e-30)
                costs.append({-1: 0.0} | {t: probe_cost * n * _ball(len(part), t) + pairs.get(j, 0) * _within(p[part], t) / at_zero for t in range(tau + 1)})
        cost, ts = allocate(costs, tau - m + 1)
        if best is None or cost < best[0]:
            best = (cost, parts, ts)
    return best[1], best[2]


# --- probing and verifying --------------------------------------------------------------------


def link_unit(fp: np.ndarray, rep: np.ndarray, home: np.ndarray, blk: np.ndarray, left: int, right: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one unit's links."""
    i, j = [], []
    for h, o in block_pairs(home, blk, left, right):
        x, y = np.nonzero(np.bitwise_count(fp[h, None] ^ fp[None, o]) <= tau)
        x, y = h[x], o[y]
        keep = rep[x] != rep[y]
        i.append(x[keep])
        j.append(y[keep])
    i, j = np.concatenate([*i, np.zeros(0, np.int64)]), np.concatenate([*j, np.zeros(0, np.int64)])
    if not len(i):
        return rep[:0], rep[:0]
    ids, inv = np.unique(rep, return_inverse=True)
    return forest(ids, inv[i], inv[j])


def probes(reps: DataFrame, parts: list[list[int]], ts: list[int]) -> DataFrame:
    """reps (fp, rep, ...) -> their rows with part and key: the own key of each used part (home) and those within its threshold."""
    rows = []
    for i, (part, t) in enumerate(zip(parts, ts, strict=True)):
        if t < 0:
            continue
        own = reps.select(F.lit(i).alias("part"), "*", key_of(F.col("fp"), part).alias("key"))
        masks = [sum(1 << b for b in c) for k in range(t + 1) for c in itertools.combinations(range(len(part)), k)]
        mask = F.explode(F.array(*[F.lit(v).cast("long") for v in masks])).alias("mask")
        rows.append(own.select("*", mask).withColumn("key", F.col("key").bitwiseXOR(F.col("mask"))).withColumn("home", F.col("mask") == 0).drop("mask"))
    return reduce(DataFrame.union, rows)


def links(reps: DataFrame, tau: int = 3) -> DataFrame:
    """reps (fp, rep), fp distinct -> edges (a, b) whose components are those of all links within tau bits."""
    placed = probes(reps, *plan(reps, tau))

    def work(g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame | None:
        fp, rep, home, blk, left, right = (g[c].to_numpy() for c in ("fp", "rep", "home", "blk", "l", "r"))
        fp = fp.view(np.uint64)
        found = [link_unit(fp[s:e], rep[s:e], home[s:e], blk[s:e], left[s], right[s], tau) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e - s > 1]
        found = [x for x in found if len(x[0])]
        return pd.DataFrame({"a": np.concatenate([x[0] for x in found]), "b": np.concatenate([x[1] for x in found])}) if found else None

    return solve(units(placed, ["part", "key"], "fp", BLOCK), ["part", "key"], work, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = 3, size: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row.

    A doc_id is one node: an id with several texts joins their components.
    Null or wordless texts have fingerprint 0 and link like any other; repeated rows come back as
    often as they went in; a null doc_id comes back with the component of its fingerprint's class;
    an empty table gives an empty result.
    """
    prints = Stored(fingerprints(docs, id_col, text_col, size), "fp").read()
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null"), "reps")
    comp = components(links(reps, tau), "simcc")
    of = reps.join(comp, reps["rep"] == comp["node"], "left").select(F.col("fp").alias("f"), F.coalesce("component", "rep").alias("component_id"))
    return prints.join(of, prints["fp"] == of["f"], "left").select("doc_id", "fp", "component_id")
