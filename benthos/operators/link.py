"""Linking detections into individuals, naming them, and matching them with ground truth.

The tracker, the truth matcher and the fusion of passes are greedy and order-dependent, so each follows
its natural unit (a recording, or a frame) in a total order, batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benthos.functions.exprs import shared_prefix, touches_edge
from benthos.storage import ship

from .groups import scan_groups, scan_tables, stream_groups
from .joins import small

# Fixed values of the tracking rules.
TRACK_IOU, RELABEL_IOU, TRACK_GAP, GAP_SAMPLES, DRIFT, BURST, GAP_CEILING = 0.15, 0.3, 1.5, 2.5, 3.0, 0.2, 30.0
MATCH_IOU, REACH, VEHICLE_SECONDS, VEHICLE_SHARE = 0.3, 0.5, 10.0, 0.8
#: Fixed: classes that aren't animals.
NOT_ANIMAL = ("equipment", "detritus sampler", "suction sampler", "anchor", "sinker", "ship container", "trash", "geologic", "sand", "marine snow", "detritus", "plantae detritus", "phyllospadix-zostera detritus", "pyrosoma detritus", "salp detritus", "bacterial mat", "amphipod tube mat", "bone", "carcass", "medusa carcass", "molt", "krill molt", "shell", "eggcase", "ink", "wood", "kelp", "mung", "carapace", "tube", "stalk", "chromista", "plantae")


def overlaps(box: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """IoU of one box with many."""
    w = np.maximum(0, np.minimum(box[2], boxes[:, 2]) - np.maximum(box[0], boxes[:, 0]))
    h = np.maximum(0, np.minimum(box[3], boxes[:, 3]) - np.maximum(box[1], boxes[:, 1]))
    both = w * h
    area = lambda b: (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1])
    union = area(box) + area(boxes) - both
    return np.where(union > 0, both / np.where(union > 0, union, 1), 0.0)


class Looks:
    """Steps between one recording's looks, in order; seconds within BURST of a look belong to it."""

    def __init__(self, recording: object):
        self.recording, self.last = recording, None

    def feed(self, rows: pd.DataFrame) -> pd.DataFrame:
        steps = []
        for s in rows["second"].tolist():
            if self.last is None or s - self.last > BURST:
                if self.last is not None:
                    steps.append(s - self.last)
                self.last = s
        return pd.DataFrame({"recording": [self.recording] * len(steps), "step": steps})

    def end(self) -> None:
        return None


def gaps(sightings: DataFrame) -> DataFrame:
    """(recording, gap): how long an animal may go unseen, 2.5 times the usual (upper median) time between looks.

    A recording with fewer than two looks isn't here; its gap is TRACK_GAP.
    """
    kind = sightings.schema["recording"].dataType.simpleString()
    looks = sightings.where("second is not null").select("recording", F.col("second").cast("double").alias("second")).distinct()
    steps = scan_groups(looks, ["recording"], ["second"], [], lambda g: Looks(g["recording"].iat[0]), f"recording {kind}, step double")
    w = Window.partitionBy("recording")
    middle = steps.withColumn("i", F.row_number().over(w.orderBy("step")) - 1).withColumn("n", F.count("*").over(w)).where(F.col("i") == F.floor(F.col("n") / 2))
    return middle.select("recording", F.least(F.lit(GAP_CEILING), F.greatest(F.lit(TRACK_GAP), F.col("step") * GAP_SAMPLES)).alias("gap"))


def pair_scores(found: np.ndarray, tracks: np.ndarray, same: np.ndarray, gate: float) -> np.ndarray:
    """How well boxes go on tracks, pair by pair (a column each): 1 + overlap where that is enough, else nearness of one taxon, else 0."""
    (fx1, fy1, fx2, fy2), (tx1, ty1, tx2, ty2) = found, tracks
    both = np.maximum(0, np.minimum(fx2, tx2) - np.maximum(fx1, tx1)) * np.maximum(0, np.minimum(fy2, ty2) - np.maximum(fy1, ty1))
    union = (fx2 - fx1) * (fy2 - fy1) + (tx2 - tx1) * (ty2 - ty1) - both
    over = np.where(union > 0, both / np.where(union > 0, union, 1), 0.0)
    out = np.where(over >= np.where(same, gate, RELABEL_IOU), 1 + over, 0.0)
    drift = same & (over < gate)
    if drift.any():
        span = np.maximum(1.0, (tx2 - tx1 + fx2 - fx1) / 2)
        moved = np.hypot((tx1 + tx2 - fx1 - fx2) / 2, (ty1 + ty2 - fy1 - fy2) / 2)
        out = np.where(drift, np.maximum(0.0, 1 - moved / (span * DRIFT)), out)
    return out


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. for count[0] places, then from start[1], and so on."""
    return np.arange(int(count.sum())) + np.repeat(start - np.cumsum(count) + count, count)


class Linker:
    """Open tracks of one recording; feed moments in time order. Ids follow creation.

    In each moment detections choose in turn, the best track that is still free. Scores don't change within a
    moment, so all propose at once and a track keeps the earliest of those that propose: the same matching,
    without a loop. Where a moment has many boxes, pairs are made by falling overlap between boxes of nearby
    cells only, and a detection goes on to the next level when it has no free track in this one.
    """

    #: Pairs that are scored at once; the least overlaps of the levels before the last, which has the pairs of one taxon.
    CHUNK, LEVELS = 32_768, (0.6, RELABEL_IOU)

    def __init__(self, gap: float, gate: float = TRACK_IOU):
        self.gap, self.gate, self.next = gap, gate, 0
        self.ids = np.zeros(0, np.int64)
        self.last = np.zeros(0)
        self.boxes = np.zeros((0, 4))
        self.taxa = np.zeros(0, np.int64)
        self.codes: dict[str | None, int] = {}

    def coded(self, taxa: list[str | None]) -> np.ndarray:
        """Numbers for taxa, the same for the same one."""
        return np.array([self.codes.setdefault(t, len(self.codes)) for t in taxa], np.int64)

    def moment(self, second: float, boxes: np.ndarray, taxa: list[str | None] | np.ndarray) -> list[int]:
        """Ids for detections of one moment, given most confident first; taxa as they are or coded."""
        keep = second - self.last <= self.gap
        if not keep.all():
            self.ids, self.last, self.boxes, self.taxa = self.ids[keep], self.last[keep], self.boxes[keep], self.taxa[keep]
        codes = taxa if isinstance(taxa, np.ndarray) else self.coded(taxa)
        free = np.flatnonzero(self.last < second)
        at = self._matched(boxes, codes, self.boxes[free], self.taxa[free])
        on, fresh = at >= 0, at < 0
        out = np.zeros(len(boxes), np.int64)
        held = free[at[on]]
        self.boxes[held], self.last[held] = boxes[on], second
        out[on] = self.ids[held]
        new = int(fresh.sum())
        out[fresh] = self.next + np.arange(new)
        self.next += new
        if new:
            self.ids = np.append(self.ids, out[fresh])
            self.last = np.append(self.last, np.full(new, second))
            self.boxes = np.concatenate((self.boxes, boxes[fresh]))
            self.taxa = np.append(self.taxa, codes[fresh])
        return out.tolist()

    def _matched(self, boxes: np.ndarray, codes: np.ndarray, tracks: np.ndarray, taxa: np.ndarray) -> np.ndarray:
        """The place in `tracks` that each box gets, or -1."""
        n, m = len(boxes), len(tracks)
        match = np.full(n, -1)
        if not n or not m:
            return match
        if n * m <= self.CHUNK or self.gate <= 0 or not (np.isfinite(boxes).all() and np.isfinite(tracks).all()):
            levels = [lambda some: self._scored(some, boxes, codes, tracks, taxa, np.arange(m), np.zeros((1, len(some)), np.int64), np.full((1, len(some)), m))]
        else:
            by = np.argsort(taxa, kind="stable")  # the last level: boxes of one taxon
            ends = [np.searchsorted(taxa[by], codes, side) for side in ("left", "right")]
            levels = [self._near(boxes, codes, tracks, taxa, x) for x in self.LEVELS]
            levels.append(lambda some: self._scored(some, boxes, codes, tracks, taxa, by, ends[0][None, some], (ends[1] - ends[0])[None, some], 0.0))
        holder, level, start, count = np.full(m, n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        ats, scores = np.zeros(0, np.int64), np.zeros(0)
        asking = np.arange(n)
        while len(asking):
            for k in np.unique(level[asking]):
                some = asking[level[asking] == k]
                row, at, score = levels[k](some)
                count[some] = np.bincount(row, minlength=len(some))
                start[some] = len(ats) + np.cumsum(count[some]) - count[some]
                ats, scores = np.concatenate((ats, at)), np.concatenate((scores, score))
            level[asking] += 1
            spent, active = [asking[count[asking] == 0]], asking[count[asking] > 0]
            while len(active):  # ascending
                c = count[active]
                p, head = _spans(start[active], c), np.cumsum(c) - c
                t = ats[p]
                s = np.where(holder[t] > np.repeat(active, c), scores[p], 0.0)
                top = np.maximum.reduceat(s, head)
                first = np.minimum.reduceat(np.where(s == np.repeat(top, c), t, m), head)
                can = top > 0
                spent.append(active[~can])
                active, first = active[can], first[can]
                got, winner = np.unique(first, return_index=True)  # the earliest of those that propose
                lost = holder[got]
                lost = lost[lost < n]
                match[lost] = -1
                holder[got] = active[winner]
                match[active[winner]] = got
                active = np.sort(np.concatenate((np.delete(active, winner), lost)))
            asking = np.sort(np.concatenate(spent))
            asking = asking[level[asking] < len(levels)]
        return match

    def _scored(self, some, boxes, codes, tracks, taxa, by, starts, counts, least: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row in `some`, track, score) of pairs that go together, by row; those that cannot overlap by `least`, or for 0 overlap or be near, are left out early.

        Row i may meet the tracks by[starts[k, i]:][:counts[k, i]] of every k.
        """
        rows, ats, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        each = counts.sum(0)
        cuts = np.searchsorted(np.cumsum(each), np.arange(0, int(each.sum()) + self.CHUNK, self.CHUNK), "left")
        cuts = np.unique(np.append(cuts, [0, len(some)]))
        mine, theirs = boxes[some].T.copy(), tracks[by].T.copy()
        own, other = [(b[2] - b[0]) * (b[3] - b[1]) for b in (mine, theirs)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            n = each[s:e]
            row, place = np.repeat(np.arange(s, e), n), _spans(starts[:, s:e].T.ravel(), counts[:, s:e].T.ravel())
            if least:
                w = np.minimum(np.repeat(mine[2, s:e], n), theirs[2][place]) - np.maximum(np.repeat(mine[0, s:e], n), theirs[0][place])
                h = np.minimum(np.repeat(mine[3, s:e], n), theirs[3][place]) - np.maximum(np.repeat(mine[1, s:e], n), theirs[1][place])
                enough = w * h * (1 + least) >= (np.repeat(own[s:e], n) + other[place]) * (least * (1 - 1e-9))
                maybe = np.flatnonzero(enough & (w > 0) & (h > 0))
                row, place = row[maybe], place[maybe]
            elif least is not None:
                f, t = np.repeat(mine[:, s:e], n, axis=1), theirs[:, place]
                span = np.maximum(1.0, (t[2] - t[0] + f[2] - f[0]) / 2) * (2 * DRIFT * (1 + 1e-9))
                maybe = np.flatnonzero((np.abs(t[0] + t[2] - f[0] - f[2]) <= span) & (np.abs(t[1] + t[3] - f[1] - f[3]) <= np.maximum(span, t[3] - t[1] + f[3] - f[1])))
                row, place = row[maybe], place[maybe]
            at = by[place]
            score = pair_scores(mine[:, row], theirs[:, place], codes[some[row]] == taxa[at], self.gate)
            good = np.flatnonzero(score >= 1 + least if least else score > 0)
            rows.append(row[good])
            ats.append(at[good])
            scores.append(score[good])
        return np.concatenate(rows), np.concatenate(ats), np.concatenate(scores)

    def _near(self, boxes, codes, tracks, taxa, least: float) -> Callable:
        """_scored for overlaps of `least`: centres are then within a share of the mean side, so tracks lie in bands, by x in each."""
        share = (1 - least) / (1 + least) * (1 + 1e-6)
        x, y = (tracks[:, 0] + tracks[:, 2]) / 2, (tracks[:, 1] + tracks[:, 3]) / 2
        fx, fy = (boxes[:, 0] + boxes[:, 2]) / 2, (boxes[:, 1] + boxes[:, 3]) / 2
        reach = [np.maximum(0.0, (boxes[:, k + 2] - boxes[:, k] + (tracks[:, k + 2] - tracks[:, k]).max()) / 2 * share) for k in (0, 1)]
        low, wide = x.min(), x.max() - x.min() + 2
        band = max(float(reach[1].max()) / 2, (y.max() - y.min()) / 1000, 1e-6)
        place = np.floor((y - y.min()) / band) * wide + (x - low)
        by = np.argsort(place, kind="stable")
        place, slack = place[by], wide * 1e-9
        top, bottom = (np.floor((fy + d * (reach[1] + slack) - y.min()) / band) for d in (-1, 1))
        left, right = (np.clip(fx - low + d * (reach[0] + slack), -0.5, wide - 1.5 + 1) for d in (-1, 1))
        bands = int((bottom - top).max()) + 1

        def pairs(some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = top[some] + np.arange(bands)[:, None]
            start, stop = np.searchsorted(place, at * wide + left[some], "left"), np.searchsorted(place, at * wide + right[some], "right")
            return self._scored(some, boxes, codes, tracks, taxa, by, start, np.where(at <= bottom[some], np.maximum(stop - start, 0), 0), least)

        return pairs


BOX = ["x1", "y1", "x2", "y2"]


class Tracker:
    """A Linker that follows one recording's rows, moment by moment, and returns `columns` of them."""

    def __init__(self, gap: float, gate: float, columns: list[str]):
        self.linker, self.columns = Linker(gap, gate), columns

    def feed(self, rows: pa.Table) -> pa.Table:
        rows = rows.filter(rows["_gap"].is_null()).combine_chunks()  # the others only tell the gap
        ids: list[int] = []
        if len(rows):
            boxes = np.stack([rows[c].to_numpy().astype(float) for c in BOX], 1)
            seconds, taxon = rows["second"].to_numpy(), rows["taxon"].chunk(0).dictionary_encode("encode")
            taxa = self.linker.coded(taxon.dictionary.to_pylist())[taxon.indices.to_numpy()]
            cuts = np.concatenate(([0], np.flatnonzero(seconds[1:] != seconds[:-1]) + 1, [len(rows)]))
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                ids += self.linker.moment(float(seconds[s]), boxes[s:e], taxa[s:e])
        return rows.select(self.columns).append_column("animal", pa.array(ids, pa.int64()))


def track(sightings: DataFrame, gap: float | None = None, gate: float = TRACK_IOU, columns: list[str] | None = None) -> DataFrame:
    """sightings (or `columns` of them) with `animal`, numbered from 0 in each recording in order of first sight.

    Needs recording, second, taxon, confidence, the box and `ord`, which breaks ties of confidence.  A task
    holds a batch of rows and the open tracks, never a recording.
    """
    ship(sightings.sparkSession)
    columns = columns or sightings.columns
    schema = ", ".join(f"`{c}` {sightings.schema[c].dataType.simpleString()}" for c in columns) + ", animal long"
    needed = list(dict.fromkeys(["recording", "second", "taxon", *BOX, *columns]))
    x = sightings.select(*needed, *[c for c in ("confidence", "ord") if c not in needed], F.lit(None).cast("double").alias("_gap"))
    if gap is None:  # a row before a recording's first tells its gap, so the sightings meet nothing and move once
        fill = {"string": "", "boolean": False} | dict.fromkeys(("byte", "short", "integer", "long", "float", "double"), 0)
        blank = [F.lit(None if f.name == "second" else fill.get(f.dataType.typeName())).cast(f.dataType).alias(f.name) for f in x.schema if f.name not in ("recording", "_gap")]
        x = x.unionByName(gaps(sightings).select("recording", *blank, F.col("gap").alias("_gap")))
    usual = TRACK_GAP if gap is None else float(gap)

    def make(rows: pa.Table) -> Tracker:
        own = rows["_gap"][0].as_py()
        return Tracker(usual if own is None else own, gate, columns)

    return scan_tables(x, ["recording"], [F.col("_gap").isNull(), F.desc("confidence"), "ord"], ["second"], [*needed, "_gap"], make, schema)


def named(tracked: DataFrame, taxonomy_lineages: DataFrame) -> DataFrame:
    """(recording, animal, taxon, agreement): what each individual's looks agree on.

    taxonomy_lineages: (name, lineage array); a name it lacks is under Unplaced.
    """
    best = F.max(F.when(F.col("taxon") != "", F.col("confidence"))).over(Window.partitionBy("recording", "animal"))
    heard = F.when((F.col("taxon") != "") & (F.col("confidence") >= F.col("best") * REACH), F.col("taxon"))
    looks = tracked.select("recording", "animal", "taxon", "confidence").withColumn("best", best).withColumn("taxon", heard)  # tracking is costly, so it is read once
    weight = looks.groupBy("recording", "animal", "taxon").agg(F.sum("confidence").alias("w"))
    lin = weight.join(small(taxonomy_lineages.select("name", "lineage")), F.col("taxon") == F.col("name"), "left").withColumn("lin", F.when(F.col("taxon").isNotNull(), F.coalesce("lineage", F.array(F.lit("Unplaced"), F.col("taxon")))))
    w = F.when(F.col("taxon").isNotNull(), F.col("w"))
    g = lin.groupBy("recording", "animal").agg(F.count("taxon").alias("n"), F.sum(w).alias("total"), F.max(w).alias("top"), F.min("taxon").alias("only"), F.collect_list("lin").alias("lins"))
    shared = F.element_at(shared_prefix(F.col("lins")), -1)
    deep = F.when(F.size(shared_prefix(F.col("lins"))) > 0, shared)
    name = F.when(F.col("n") == 1, F.col("only")).when((F.col("n") == 0) | deep.isNull() | deep.isin("Unplaced", "Animalia"), F.lit("Undecided")).otherwise(deep)
    agree = F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, 1.0).otherwise(F.col("top") / F.when(F.col("total") != 0, F.col("total")).otherwise(1.0))
    return g.select("recording", "animal", name.alias("taxon"), F.coalesce(agree, F.lit(0.0)).alias("agreement"))


def animals(tracked: DataFrame, width: int = 640, height: int = 360) -> DataFrame:
    """One row an individual: span, frames, best look, whether it is the vehicle."""
    box = [F.col(c) for c in BOX]
    g = tracked.groupBy("recording", "animal").agg(F.min("second").alias("first_second"), F.max("second").alias("last_second"), F.count("*").alias("frames"), F.avg(touches_edge(box, width, height).cast("int")).alias("edge"), F.min(F.struct((-F.col("confidence")).alias("c"), "second", "ord", "taxon", *BOX)).alias("best"))
    span = F.col("last_second") - F.col("first_second")
    return g.select("recording", "animal", "first_second", "last_second", "frames", span.alias("seconds"), (-F.col("best.c")).alias("confidence"), F.col("best.taxon").alias("best_taxon"), ((span >= VEHICLE_SECONDS) & (F.col("edge") >= VEHICLE_SHARE)).alias("vehicle"))


def is_animal(taxon):
    return ~F.lower(F.trim(taxon)).isin(*NOT_ANIMAL)


def match_truth(found: DataFrame, truth: DataFrame, keys: list[str], min_iou: float = MATCH_IOU) -> DataFrame:
    """found with `landed_on`: the truth identity each detection claims, greedily by confidence, or null.

    found: keys, conf, ord, box; truth: keys, track, ord, box. Equal overlaps go to the later truth box.
    """
    cols = [f.name for f in found.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", landed_on long"
    blank = lambda f: F.lit(0 if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte") else "" if f.dataType.typeName() == "string" else None).cast(f.dataType).alias(f.name)
    own = {*keys, "ord", *BOX}
    t = truth.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in own else blank(f) for f in found.schema], F.lit(0).alias("_side"), F.col("track").cast("long").alias("_track"))
    both = t.unionByName(found.select(*cols, F.lit(1).alias("_side"), F.lit(0).cast("long").alias("_track")))

    def work(g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        boxes, side, ids = g[BOX].to_numpy(float), g["_side"].to_numpy(), g["_track"].to_numpy()
        landed, hit = np.zeros(len(g), np.int64), np.zeros(len(g), bool)
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            m = s + int((side[s:e] == 0).sum())
            tb, taken = boxes[s:m], np.zeros(m - s, bool)
            for i in range(m, e) if m > s else ():
                over = np.where(taken, -1.0, overlaps(boxes[i], tb))
                k = len(over) - 1 - int(over[::-1].argmax())
                if over[k] >= min_iou:
                    taken[k], hit[i], landed[i] = True, True, ids[s + k]
        mine = side == 1
        return g.loc[mine, cols].assign(landed_on=pd.array(np.where(hit, landed, 0)[mine], "Int64").copy()).assign(landed_on=lambda d: d["landed_on"].mask(~hit[mine]))

    return stream_groups(both, keys, ["_side", F.when(F.col("_side") == 1, -F.col("conf")), "ord"], work, schema)


def fuse_passes(boxes: DataFrame, passes: int, keys: list[str]) -> DataFrame:
    """Boxes of several passes over one frame grouped into animals: IoU >= .45 or containment >= .7, one vote a pass.

    confidence is the mean vote over all passes, absent ones counting nothing.
    """
    kind = {f.name: f.dataType.simpleString() for f in boxes.schema}
    schema = ", ".join([*[f"`{k}` {kind[k]}" for k in keys], "label string, votes long, confidence double, x1 double, y1 double, x2 double, y2 double"])

    def work(g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        b, votes_of, passes_of = g[BOX].to_numpy(float), g["confidence"].to_numpy(), g["pass_no"].to_numpy()
        area, rows = np.maximum((b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1]), 1e-9), []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            left = np.ones(e - s, bool)
            for i in range(s, e):
                if not left[i - s]:
                    continue
                w = np.maximum(0, np.minimum(b[i, 2], b[s:e, 2]) - np.maximum(b[i, 0], b[s:e, 0]))
                h = np.maximum(0, np.minimum(b[i, 3], b[s:e, 3]) - np.maximum(b[i, 1], b[s:e, 1]))
                same = left & ((overlaps(b[i], b[s:e]) >= 0.45) | (w * h / np.minimum(area[s:e], area[i]) >= 0.7))
                same[i - s] = True
                left &= ~same
                at = s + np.flatnonzero(same)
                _, first = np.unique(passes_of[at], return_index=True)  # the surest box of each pass
                rows.append((i, len(first), round(float(votes_of[at[np.sort(first)]].sum()) / passes, 5)))
        at = [r[0] for r in rows]
        out = g.iloc[at][[*keys, "taxon", *BOX]].rename(columns={"taxon": "label"}).assign(votes=[r[1] for r in rows], confidence=[r[2] for r in rows])
        return out[[*keys, "label", "votes", "confidence", *BOX]].astype({c: float for c in BOX})

    return stream_groups(boxes, keys, [F.desc("confidence"), "ord"], work, schema)


def distinct_individuals(sightings: DataFrame, keys: list[str], min_iou: float = 0.3) -> DataFrame:
    """Rows that no more confident row of their slice overlaps by `min_iou` or more."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sightings.schema)

    def work(g: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        b, kept = g[BOX].to_numpy(float), []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            mine: list[int] = []
            for i in range(s, e):
                if not mine or overlaps(b[i], b[mine]).max() < min_iou:
                    mine.append(i)
            kept += mine
        return g.iloc[kept]

    return stream_groups(sightings, keys, [F.desc("confidence"), "ord"], work, schema)


# --- scores -----------------------------------------------------------------------------------


def curve(judged: DataFrame, truth_total: DataFrame | None, by: list[str]) -> DataFrame:
    """judged (by, conf, ord, hit) -> precision and recall as the floor is lowered, a row a detection.

    truth_total: (by, truth_boxes).
    """
    w = Window.partitionBy(*by).orderBy(F.desc("conf"), "ord")
    x = judged.withColumn("rank", F.row_number().over(w)).withColumn("hits", F.sum(F.col("hit").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    x = x.join(truth_total, by, "left") if by else x.crossJoin(F.broadcast(truth_total))
    return x.select(*by, F.round("conf", 5).alias("confidence"), "rank", (F.col("hits") / F.col("rank")).alias("precision"), F.coalesce(F.try_divide(F.col("hits"), F.col("truth_boxes")), F.lit(0.0)).alias("recall"))


def at_precision(points: DataFrame, floor: float, by: list[str]) -> DataFrame:
    """The most recall at a precision of at least `floor`, and the confidence that first reaches it."""
    ok = F.col("precision") >= floor
    best = F.max(F.when(ok, F.struct("recall", "confidence")))
    return points.groupBy(*by).agg(best.alias("b")).select(*by, F.col("b.recall").alias("recall"), F.col("b.confidence").alias("confidence"))


def pooled(judged: DataFrame, truth: DataFrame, everything: DataFrame, floor: float) -> DataFrame:
    """One row for all recordings together: judged (recording, conf, ord, landed_on) against truth.

    truth: (recording, truth_boxes) of the frames that were looked at; everything: (recording, truth_boxes_all,
    animals_all, frames_annotated, frames_judged).  Identities belong to a recording.  overall_at_floor is the
    most recall at that precision, rescaled to the whole recordings.
    """
    hit = F.col("landed_on").isNotNull()
    found = judged.agg(F.count("*").alias("detections"), F.count("landed_on").alias("matched"), F.count_distinct(F.when(hit, F.struct("recording", "landed_on"))).alias("animals_found"))
    boxes = truth.agg(F.sum("truth_boxes").alias("truth_boxes"))
    whole = everything.agg(*[F.sum(c).alias(c) for c in ("truth_boxes_all", "animals_all", "frames_annotated", "frames_judged")])
    best = at_precision(curve(judged.select("conf", "ord", hit.alias("hit")), boxes, []), floor, [])
    x = found.crossJoin(boxes).crossJoin(whole).crossJoin(best)  # one row each
    part = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return x.select("detections", "matched", part("matched", "detections").alias("precision"), part("matched", "truth_boxes").alias("recall"), part("matched", "truth_boxes_all").alias("recall_overall"), part("animals_found", "animals_all").alias("recall_animals"), part("frames_judged", "frames_annotated").alias("looked_at"), F.col("recall").alias("at_floor"), overall(F.col("recall"), F.col("truth_boxes"), F.col("truth_boxes_all")).alias("overall_at_floor"))


def overall(recall, truth_boxes, truth_boxes_all):
    """Recall over what was looked at, as recall over the whole recording."""
    return F.try_divide(recall * truth_boxes, F.nullif(truth_boxes_all, F.lit(0)))
