"""Which recordings to read: dives by depth, evenly spread, on the bottom."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def spread(items: DataFrame, most: int, by: list[str], order: list[str]) -> DataFrame:
    """`most` rows of each group, evenly spaced in order: rows min(n - 1, int(i n / most)); all if there are fewer."""
    if most <= 0:
        return items
    w = Window.partitionBy(*by)
    x = items.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    step = F.col("_n") / F.lit(float(most))
    picks = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.least(F.col("_n") - 1, F.floor(k * step)).cast("int"))
    return x.where((F.col("_n") <= most) | F.array_contains(picks, F.col("_i"))).drop("_i", "_n")


def dives(videos: DataFrame) -> DataFrame:
    """(dive, videos, max_depth_m), deepest first: one row a dive."""
    return videos.where("dive is not null").groupBy("dive").agg(F.count("*").alias("videos"), F.coalesce(F.max("depth_m"), F.lit(0.0)).alias("max_depth_m"))


def on_the_bottom(videos: DataFrame, windows: DataFrame) -> DataFrame:
    """Videos inside their dive's working window; all of a dive without a window, without clocks, or left with none."""
    j = videos.join(windows, "dive", "left")
    inside = F.col("start").isNull() | F.col("stop").isNull() | F.col("recorded_at").isNull() | F.col("recorded_at").between(F.col("start"), F.col("stop"))
    n = F.sum(inside.cast("int")).over(Window.partitionBy("dive"))
    return j.withColumn("_in", inside).withColumn("_n", n).where("_in or _n = 0").drop("_in", "_n", "start", "stop")


def choose(videos: DataFrame, top: int, per_dive: int, most: int) -> DataFrame:
    """Evenly spread videos of the deepest dives, then evenly spread over all of those."""
    deep = dives(videos).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("max_depth_m"), "dive"))).where(F.col("rank") <= top)  # a row a dive
    picked = spread(videos.join(deep.select("dive", "rank"), "dive"), per_dive, ["dive"], ["url"])
    return spread(picked, most, [], ["rank", "url"]) if most else picked
