"""What each slice was doing, and the windows worth opening.

Thresholds belong to a recording, so they are one grouped aggregate joined back by recording; runs are
islands over a window; nearby runs are merged by a scan of each recording's sorted runs, which keeps the
exact newest-first rule and holds only the windows that can still grow.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benthos.functions.exprs import finite, nearest_rank
from benthos.storage import ship

from .groups import scan_groups

# Fixed values of the verdict rules.
FROZEN_BELOW, DWELL, ACTIVE, EMPTY_RATIO, MIN_ROWS, MERGE_GAP = 0.01, 0.15, 0.90, 0.2, 2, 10
VERDICTS = ("frozen", "subject", "unnamed", "dwell", "empty", "active")


def timeline(slices: DataFrame, detail: str = "std_intensity") -> DataFrame:
    """Slices with a finite movement, under the names the rules use."""
    return slices.where(finite(F.col("frame_difference"))).select("name", F.col("dim_t").alias("t"), F.col("frame_difference").alias("movement"), F.col(detail).alias("structure"), F.col("detection_count").alias("detections"), F.col("moving_object_count").alias("movers"), F.col("detection_top_class").alias("top_class"), F.col("detection_confidence").alias("confidence"), "fps")


def thresholds(line: DataFrame) -> DataFrame:
    """(name, dwell_below, active_above, detail) from each recording's own values; nearest-rank percentiles."""
    moving = F.collect_list(F.when(F.col("movement") >= FROZEN_BELOW, F.col("movement")))
    return line.groupBy("name").agg(nearest_rank(moving, DWELL).alias("dwell_below"), nearest_rank(F.collect_list("movement"), ACTIVE).alias("active_above"), nearest_rank(F.collect_list(F.when(finite(F.col("structure")), F.col("structure"))), 0.5).alias("detail"))


def classify(movement: Column, structure: Column, detections: Column, movers: Column, dwell: Column, active: Column, detail: Column) -> Column:
    """The six verdicts in order of argument; null if none holds."""
    empty = (detail > 0) & finite(structure) & (structure < detail * EMPTY_RATIO)
    return (
        F.when(~finite(movement), None)
        .when(movement < FROZEN_BELOW, "frozen")
        .when(detections > 0, "subject")
        .when(movers > 0, "unnamed")
        .when(movement <= dwell, F.when(empty, "empty").otherwise("dwell"))
        .when(movement >= active, "active")
    )


def verdicts(line: DataFrame) -> DataFrame:
    """The timeline with its verdict."""
    c = F.col
    return line.join(thresholds(line), "name").withColumn("verdict", classify(c("movement"), c("structure"), c("detections"), c("movers"), c("dwell_below"), c("active_above"), c("detail"))).drop("dwell_below", "active_above", "detail")


def seconds(judged: DataFrame) -> DataFrame:
    """Per recording, footage_seconds and seconds of each verdict: slices times the first gap over fps.

    fps is the first non-zero one; frames are returned where there is none.
    """
    by_t = F.struct("t", "fps")
    first_two = F.slice(F.sort_array(F.collect_list("t")), 1, 2)
    step = F.when(F.size(first_two) > 1, F.get(first_two, 1) - F.get(first_two, 0)).otherwise(1)
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
    agg = judged.groupBy("name").agg(step.alias("step"), F.min(F.when(F.col("fps") != 0, by_t))["fps"].alias("rate"), F.count("*").alias("n"), *counts)
    to = lambda n: F.col(n) * F.col("step") / F.coalesce("rate", F.lit(1.0))
    return agg.select("name", to("n").alias("footage_seconds"), *[to(v).alias(f"verdict_seconds_{v}") for v in VERDICTS])


def runs(judged: DataFrame) -> DataFrame:
    """(name, kind, label, s, e): maximal stretches of one verdict and label, in slice positions."""
    w = Window.partitionBy("name").orderBy("t")
    label = F.when(F.col("verdict") == "subject", F.coalesce("top_class", F.lit(""))).otherwise(F.lit(None))
    at = judged.select("name", "t", F.col("verdict").alias("kind"), label.alias("label"), (F.row_number().over(w) - 1).alias("i"))
    key = F.struct("kind", "label")
    fresh = at.withColumn("new", (~key.eqNullSafe(F.lag(key).over(w))).cast("int")).withColumn("run", F.sum("new").over(w))
    return fresh.where("kind is not null").groupBy("name", "run", "kind", "label").agg(F.min("i").alias("s"), F.max("i").alias("e")).drop("run")


class Merger:
    """Runs of one recording, in order, into windows.

    A run joins the newest window of its kind and label, looking back from the newest window to the first
    that ended over `gap` slices ago.  That one and all behind it never change again, so only those in
    front of it are kept: one for each kind and label at most.
    """

    def __init__(self, name: str, gap: int):
        self.name, self.gap = name, gap
        self.open: list[list] = []  # [kind, label, s, e], newest first

    def _rows(self, windows: list[list]) -> pd.DataFrame | None:
        return pd.DataFrame([(self.name, *w) for w in windows], columns=["name", "kind", "label", "s", "e"]) if windows else None

    def feed(self, rows: pd.DataFrame) -> pd.DataFrame | None:
        done: list[list] = []
        for kind, label, s, e in zip(rows["kind"], rows["label"], rows["s"].tolist(), rows["e"].tolist(), strict=True):
            stop = next((i for i, w in enumerate(self.open) if s - w[3] - 1 > self.gap), len(self.open))
            done += self.open[stop:]
            del self.open[stop:]
            same = next((w for w in self.open if w[0] == kind and w[1] == label), None)
            if same is not None:
                same[3] = max(same[3], e)
            else:
                self.open.insert(0, [kind, label, s, e])
        return self._rows(done)

    def end(self) -> pd.DataFrame | None:
        return self._rows(self.open)


def merged(run_rows: DataFrame, gap: int = MERGE_GAP) -> DataFrame:
    """Runs joined to the newest open run of their kind and label, looking back until one ended over `gap` slices ago."""
    ship(run_rows.sparkSession)
    return scan_groups(run_rows.select("name", "kind", "label", "s", "e"), ["name"], ["s"], [], lambda g: Merger(g["name"].iat[0], gap), "name string, kind string, label string, s int, e int")


def windows(judged: DataFrame) -> DataFrame:
    """Merged runs that are long enough: two slices, or one for a named subject; none for timelines under two slices."""
    return merged(runs(judged)).where((F.col("kind") == "subject") | (F.col("e") - F.col("s") + 1 >= MIN_ROWS))


def described(judged: DataFrame, wins: DataFrame) -> DataFrame:
    """Windows with their times, mean movement and detections, best confidence and class."""
    w = Window.partitionBy("name").orderBy("t")
    at = judged.withColumn("i", F.row_number().over(w) - 1).withColumnRenamed("name", "n2")
    each = wins.withColumn("j", F.explode(F.sequence("s", "e")))
    x = each.join(at, (F.col("name") == F.col("n2")) & (F.col("i") == F.col("j")))
    best = F.coalesce("confidence", "detections")
    named = F.max_by("top_class", F.when(F.col("top_class").isNotNull() & best.isNotNull(), F.struct(best.alias("b"), (-F.col("i")).alias("i"))))
    return x.groupBy("name", "kind", "label", "s", "e").agg(F.min("t").alias("from_t"), F.max("t").alias("to_t"), F.avg("movement").alias("movement"), F.avg("detections").alias("detections"), F.max("confidence").alias("confidence"), named.alias("named")).withColumn("top_class", F.coalesce(F.nullif("label", F.lit("")), "named")).withColumn("slices", F.col("e") - F.col("s") + 1).drop("named")


def interest(events: DataFrame, line: DataFrame) -> DataFrame:
    """Events with a score: how many doublings from the recording's median movement, by length."""
    base = line.groupBy("name").agg(nearest_rank(F.collect_list("movement"), 0.5).alias("median"))
    ratio = F.try_divide(F.col("movement") + FROZEN_BELOW / 10, F.col("median"))
    return events.join(base, "name").withColumn("score", F.abs(F.log2(ratio)) * F.log2(1 + F.col("slices"))).drop("median")


def describe(report: DataFrame, judged: DataFrame) -> DataFrame:
    """A report with slice_verdict on its slices and the seconds on its recording rows; earlier columns are replaced."""
    totals = seconds(judged)
    had = [c for c in ["slice_verdict", *totals.columns[1:]] if c in report.columns]
    v = judged.select("name", F.col("t").alias("dim_t"), F.col("verdict").alias("slice_verdict")).dropDuplicates(["name", "dim_t"])
    out = report.drop(*had).join(v, ["name", "dim_t"], "left")
    joined = out.join(totals, "name", "left")
    own = F.col("obs_level") == 0
    return joined.select(*out.columns, *[F.when(own, F.col(c)).alias(c) for c in totals.columns[1:]])
