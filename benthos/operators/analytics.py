"""Composition, rates, accumulation, profiles, places: what a collection looks like along an axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benthos.functions.exprs import UNITS, depth_step, time_bucket

MOST_BANDS, PROFILE_POINTS, DIVE_GAP_HOURS, BANDS = 9, 4000, 6, 240


def unit_for_span(at: DataFrame, col: str) -> str:
    """The bucket unit for the span of days covered, counted by whole days; a day if there is one day or none."""
    lo, hi, n = at.agg(F.min(F.to_date(col)), F.max(F.to_date(col)), F.count_distinct(F.to_date(col))).first()
    return "day" if n < 2 else next(u for u, _, most in UNITS if (hi - lo).days <= most)


def step_for_depth(df: DataFrame, col: str = "depth_m") -> int:
    return df.agg(depth_step(F.min(col), F.max(col))).first()[0] or 500


def cube(slices: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, taxon, grp, animals): detections by bucket, class and group."""
    return slices.withColumn("bucket", bucket).where("bucket is not null").groupBy("bucket", F.col("detection_top_class").alias("taxon"), F.col("expedition").alias("grp")).agg(F.coalesce(F.sum("detection_count"), F.lit(0.0)).alias("animals"))


def footage_seconds(slices: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, seconds): each slice lasts to the next of its recording; the last has no length."""
    w = Window.partitionBy("name").orderBy("dim_t")
    x = slices.withColumn("bucket", bucket).withColumn("next_t", F.lead("dim_t").over(w)).where("next_t is not null and fps > 0 and bucket is not null")
    return x.groupBy("bucket").agg(F.sum((F.col("next_t") - F.col("dim_t")) / F.col("fps")).alias("seconds"))


def rate(counts: DataFrame, seconds: DataFrame) -> DataFrame:
    """(bucket, animals, seconds, rate): null where no footage."""
    per = counts.groupBy("bucket").agg(F.sum("animals").alias("animals"))
    return per.join(seconds, "bucket", "left").withColumn("rate", F.when(F.col("seconds") > 0, F.col("animals") / F.col("seconds")))


def rank_of(taxonomy: DataFrame, df: DataFrame, rank: str, not_animal: tuple[str, ...] = ()) -> DataFrame:
    """df with `band`, its taxon's name at a rank, or why it has none."""
    t = taxonomy.select(F.col("name").alias("_n"), F.col(rank).alias("_r"))
    band = F.when(F.col("taxon").isNull() | (F.col("taxon") == ""), F.lit("Unnamed")).when(F.col("_r").isNotNull(), F.col("_r")).when(F.col("_n").isNotNull(), F.lit(f"{rank} unrecorded")).when(F.col("taxon").isin(*not_animal) if not_animal else F.lit(False), F.lit("Not an animal")).otherwise(F.lit("Unplaced"))
    return df.join(t, df["taxon"] == t["_n"], "left").withColumn("band", band).drop("_n", "_r")


def composition(banded: DataFrame, most: int = MOST_BANDS) -> DataFrame:
    """(bucket, band, animals): the biggest bands, the rest folded into "n more"."""
    some = banded.where("animals > 0")
    totals = some.groupBy("band").agg(F.sum("animals").alias("t"))
    ranked = totals.withColumn("r", F.row_number().over(Window.orderBy(F.desc("t"), "band"))).withColumn("n", F.count("*").over(Window.partitionBy()))  # a row for each band
    label = F.when(F.col("r") <= most, F.col("band")).otherwise(F.concat((F.col("n") - most).cast("string"), F.lit(" more")))
    return some.join(ranked.select(F.col("band").alias("_b"), label.alias("shown")), F.col("band") == F.col("_b")).groupBy("bucket", F.col("shown").alias("band")).agg(F.sum("animals").alias("animals"))


def accumulation(counts: DataFrame) -> DataFrame:
    """(bucket, fresh, cumulative): kinds first seen in each bucket and so far; buckets without any stay."""
    first = counts.where("taxon is not null and taxon <> ''").groupBy("taxon").agg(F.min("bucket").alias("bucket"))
    fresh = first.groupBy("bucket").agg(F.count("*").alias("fresh"))
    every = counts.select("bucket").distinct().join(fresh, "bucket", "left").select("bucket", F.coalesce("fresh", F.lit(0)).alias("fresh"))
    return every.withColumn("cumulative", F.sum("fresh").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)))  # a row for each bucket


def profiles(slices: DataFrame, points: int = PROFILE_POINTS) -> DataFrame:
    """(rec, grp, stamp, depth): at most about `points` points, averaged over equal stretches of time."""
    x = slices.where("depth_m is not null and recorded_at is not null").select(F.col("name").alias("rec"), F.col("expedition").alias("grp"), (F.unix_micros(F.col("recorded_at").cast("timestamp")) / 1e6).alias("stamp"), F.col("depth_m").alias("depth"))
    n = x.count()
    if n <= points:
        return x
    every = -(-n // points)
    return x.groupBy("rec", "grp", F.floor(F.col("stamp") / every).alias("b")).agg(F.min("stamp").alias("stamp"), F.avg("depth").alias("depth")).drop("b")


def dives(points: DataFrame, gap_hours: float = DIVE_GAP_HOURS) -> DataFrame:
    """(dive, start_stamp, points, segments, hours): sessions of the whole clock, split at gaps over `gap_hours`.

    The clock is global, so the rows are the down-sampled profile, not the slices.
    """
    w = Window.orderBy("stamp", "rec")
    gap = F.col("stamp") - F.lag("stamp").over(w)
    x = points.withColumn("new", F.coalesce((gap > gap_hours * 3600).cast("int"), F.lit(1))).withColumn("prev", F.lag("rec").over(w)).withColumn("dive", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    seg = F.sum(((F.col("new") == 1) | (F.col("rec") != F.col("prev"))).cast("int"))
    return x.groupBy("dive").agg(F.min("stamp").alias("start_stamp"), F.count("*").alias("points"), seg.alias("segments"), ((F.max("stamp") - F.min("stamp")) / 3600).alias("hours"))


def relative_depth(slices: DataFrame) -> DataFrame:
    """(name, dim_t, change): depth below the recording's first known depth."""
    w = Window.partitionBy("name").orderBy("dim_t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return slices.select("name", "dim_t", (F.col("depth_m") - F.first("depth_m", ignorenulls=True).over(w)).alias("change"))


def flatness(slices: DataFrame) -> DataFrame:
    """One row (typical, most, axis): the upper median and largest span of a recording, and the whole axis."""
    spans = slices.where("depth_m is not null").groupBy("name").agg(F.min("depth_m").alias("lo"), F.max("depth_m").alias("hi"))
    s = F.sort_array(F.collect_list(F.col("hi") - F.col("lo")))
    return spans.agg(F.get(s, F.floor(F.size(s) / 2).cast("int")).alias("typical"), F.max(F.col("hi") - F.col("lo")).alias("most"), (F.max("hi") - F.min("lo")).alias("axis"))


def footage_by_median(slices: DataFrame) -> DataFrame:
    """(name, seconds): rows times the median gap over the first fps (30 where there is none)."""
    w = Window.partitionBy("name").orderBy("dim_t")
    x = slices.withColumn("gap", F.col("dim_t") - F.lag("dim_t").over(w))
    g = x.groupBy("name").agg(F.count("*").alias("n"), F.median("gap").alias("step"), F.min(F.when(F.col("fps") > 0, F.struct("dim_t", "fps")))["fps"].alias("fps"))
    return g.select("name", (F.col("n") * F.coalesce("step", F.lit(1.0)) / F.coalesce("fps", F.lit(30.0))).alias("seconds"))


def placed(points: DataFrame, by: list[str]) -> DataFrame:
    """Mean latitude, circular mean longitude, and the edges around the widest gap in longitude."""
    rad = F.radians("longitude")
    mean = points.groupBy(*by).agg(F.avg("latitude").alias("latitude"), F.degrees(F.atan2(F.sum(F.sin(rad)), F.sum(F.cos(rad)))).alias("mean_longitude"))
    w = Window.partitionBy(*by).orderBy("longitude")
    d = points.select(*by, "longitude").distinct().withColumn("next", F.lead("longitude").over(w)).withColumn("first", F.min("longitude").over(Window.partitionBy(*by)))
    gap = d.select(*by, F.col("longitude").alias("east"), F.coalesce("next", "first").alias("west"), (F.coalesce("next", F.col("first") + 360.0) - F.col("longitude")).alias("gap"))
    edge = gap.groupBy(*by).agg(F.max(F.struct("gap", "east", "west")).alias("g")).select(*by, F.col("g.west").alias("west"), F.col("g.east").alias("east"), (360.0 - F.col("g.gap")).alias("width"))
    return mean.join(edge, by)


def bands(rows: DataFrame, value: str, n: int = BANDS) -> DataFrame:
    """(name, band, value): a recording's rows averaged into n bands; band b takes rows int(b N / n) up to int((b + 1) N / n), one at least."""
    w = Window.partitionBy("name")
    x = rows.withColumn("i", F.row_number().over(w.orderBy("dim_t")) - 1).withColumn("N", F.count("*").over(w))
    count = x.select("name", "N").distinct().withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    first = F.floor(F.col("band") * F.col("N") / n).cast("int")
    last = F.greatest(F.floor((F.col("band") + 1) * F.col("N") / n).cast("int"), first + 1)
    each = count.withColumn("i", F.explode(F.sequence(first, last - 1))).drop("N")
    return each.join(x.select("name", "i", value), ["name", "i"]).groupBy("name", "band").agg(F.avg(value).alias(value))


def hit_windows(hits: DataFrame, gap: float = 4.0) -> DataFrame:
    """(name, start, stop): moments with a detection, joined while at most `gap` seconds apart."""
    w = Window.partitionBy("name").orderBy("second")
    x = hits.withColumn("new", F.coalesce((F.col("second") - F.lag("second").over(w) > gap).cast("int"), F.lit(1))).withColumn("n", F.sum("new").over(w))
    return x.groupBy("name", "n").agg(F.min("second").alias("start"), F.max("second").alias("stop")).drop("n")


def frames_to_visit(wins: DataFrame, fps: float, pad: float, duration: float, step: int) -> DataFrame:
    """(name, frame): frames inside the padded windows at a coarser step, aligned to it."""
    a = F.floor(F.greatest(F.lit(0.0), F.col("start") - pad) * fps).cast("long")
    b = F.floor(F.least(F.lit(duration), F.col("stop") + pad) * fps).cast("long")
    return wins.select("name", F.explode(F.sequence(a - a % step, b, F.lit(step).cast("long"))).alias("frame")).distinct()
