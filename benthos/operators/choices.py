"""Which events, species and moments a page shows, and in what order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the page.
FINDINGS, LEGEND = ("subject", "unnamed"), 12
#: Fixed: sort keys; the two last take nothing as 0.
SORTS = {"interest": ("score", True, False), "time": ("from_t", False, False), "duration": ("slices", True, False), "movement": ("movement", True, False), "particles": ("objects", True, False), "animals": ("detections", True, True), "confidence": ("confidence", True, True)}
#: Fixed: what may be plotted, where the report has it.
MEASURES = ("frame_difference", "detection_count", "camera_speed", "moving_object_count", "moving_object_area", "depth_m", "altitude_m", "colourfulness")
#: Fixed: the columns that a view of the page needs.
NEEDS = {"gallery": ("frame_difference", "dim_t"), "profile": ("depth_m", "dim_t"), "biodiversity": ("recorded_at", "detection_top_class", "dim_t")}
#: Slice times in one bucket of a range join.
BUCKET = 4096


def of_kind(kind: Column, wanted: str) -> Column:
    """all, found (something was found), or one kind."""
    return F.lit(True) if wanted == "all" else kind.isin(*FINDINGS) if wanted == "found" else kind == wanted


def good(kind: Column, slices: Column, confidence: Column, floor: float, least: int) -> Column:
    """Named events may be short; without a finite confidence only they fall to a floor."""
    known = confidence.isNotNull() & ~F.isnan(confidence)
    sure = F.when(known, confidence >= floor).otherwise(kind != "subject") if floor else F.lit(True)
    return ((kind == "subject") | (slices >= least)) & sure


def above(confidence: Column, floor: float) -> Column:
    """Whether a count takes a sighting at this floor; one without a finite confidence passes."""
    return confidence.isNull() | F.isnan(confidence) | (confidence >= floor)


def species(events: DataFrame) -> DataFrame:
    """(taxon): the names that events have, in order."""
    return events.where("top_class is not null and top_class <> ''").select(F.col("top_class").alias("taxon")).distinct().orderBy("taxon")


def of_species(events: DataFrame, wanted: str) -> DataFrame:
    """Events of a species; all of them for "all" or a species that no event has."""
    if wanted == "all":
        return events
    any_of = events.agg(F.coalesce(F.bool_or(F.col("top_class") == wanted), F.lit(False)).alias("_any"))  # one row
    return events.crossJoin(F.broadcast(any_of)).where(~F.col("_any") | (F.col("top_class") == wanted)).drop("_any")


def order_of(key: str) -> Column:
    """The order of a sort; descending ones put missing values last, as 0 where the key says so."""
    column, down, zero = SORTS[key]
    value = F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0)) if zero else F.col(column).cast("double")
    return value.desc_nulls_last() if down else value.asc_nulls_first()


def preview(slices: DataFrame, entries: Column, order: list[Column | str], most: int) -> DataFrame:
    """(crop, class) of the first `most` crops of the 3 x most surest slices with detections."""
    top = slices.where(entries.isNotNull()).withColumn("_e", entries).orderBy(F.col("detection_confidence").desc_nulls_last(), *order).limit(3 * most)
    n = F.row_number().over(Window.orderBy(F.col("detection_confidence").desc_nulls_last(), *order)) - 1  # at most 3 x most rows
    shots = top.withColumn("_n", n).select("_n", F.posexplode(cropped(F.col("_e"))).alias("_i", "_d"))
    return shots.orderBy("_n", "_i").limit(most).select(F.col("_d.crop").alias("crop"), F.col("_d.class").alias("class"))


def cropped(entries: Column) -> Column:
    """The detections that have a picture."""
    return F.filter(entries, lambda d: d["crop"].isNotNull() & (d["crop"] != ""))


def with_picture(animals: DataFrame, crop: str) -> DataFrame:
    """Animals whose best look has a picture."""
    return animals.where(F.col(crop).isNotNull() & (F.col(crop) != ""))


def frames_of(events: DataFrame, looks: DataFrame) -> DataFrame:
    """events (name, from_t, to_t, top_class) with each look (name, t, class) in their range that is of their species.

    Times are cut into buckets, so a recording's events never meet all its looks.  Look columns get r_.
    """
    part = lambda c: F.floor(F.col(c) / BUCKET)
    e = events.withColumn("_b", F.explode(F.sequence(part("from_t"), part("to_t"))))
    r = looks.select(*[F.col(c).alias(f"r_{c}") for c in looks.columns]).withColumn("_rb", part("r_t"))
    mine = F.col("top_class").isNull() | (F.col("top_class") == "") | (F.col("r_class") == F.col("top_class"))
    return e.join(r, (F.col("name") == F.col("r_name")) & (F.col("_b") == F.col("_rb"))).where(F.col("r_t").between(F.col("from_t"), F.col("to_t")) & mine).drop("_b", "_rb", "r_name")


def picks(n: Column, sample: int) -> Column:
    """At most `sample` of n positions, evenly spread from the first to the last."""
    k = F.least(F.lit(sample), n)
    step = (n - 1) / F.greatest(k - 1, F.lit(1))
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.when((i == k - 1) & (k > 1), n - 1).otherwise(F.floor(i * step)).cast("int")))).otherwise(F.array().cast("array<int>"))


def legend(branches: DataFrame, most: int = LEGEND) -> DataFrame:
    """branches (name, animals) -> the biggest, or nothing where there would be fewer than two."""
    one = branches.where("name is not null and name <> ''").groupBy("name").agg(F.max("animals").alias("animals"))
    top = one.orderBy(F.desc("animals"), "name").limit(most)
    return top.withColumn("_n", F.count("*").over(Window.partitionBy())).where("_n > 1").drop("_n")  # at most `most` rows


def lacking(groups: DataFrame, judged: DataFrame) -> DataFrame:
    """One row (short, groups): how many groups have nothing judged."""
    have = judged.select("grp").distinct().withColumn("_j", F.lit(1))
    return groups.select("grp").distinct().join(have, "grp", "left").agg(F.count_if(F.col("_j").isNull()).alias("short"), F.count("*").alias("groups"))


def measures(columns: list[str]) -> list[str]:
    """What of a report can be plotted."""
    return [c for c in MEASURES if c in columns]


def offers(view: str, columns: list[str]) -> bool:
    """Whether a report has what a view needs."""
    return all(c in columns for c in NEEDS[view])


def totals(rows: DataFrame) -> DataFrame:
    """One row of the collection: listed, processed, seconds, animals, with_animals, taxa, ran, combined."""
    add = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return rows.agg(add("listed"), add("processed"), add("seconds"), add("animals"), add("with_animals"), F.size(F.array_distinct(F.flatten(F.collect_list("taxa")))).alias("taxa"), F.count_if(F.col("processed") > 0).alias("ran"))


def share(rows: DataFrame) -> DataFrame:
    """rows with `share`, the per cent of what is listed that was read; 0 where nothing is listed."""
    return rows.withColumn("share", F.coalesce(F.try_divide(F.col("processed") * 100.0, F.col("listed")), F.lit(0.0)))


def chosen_of(videos: DataFrame, chosen: DataFrame) -> DataFrame:
    """(title, chosen, listed, dives) of each expedition."""
    of = chosen.groupBy("title").agg(F.count("*").alias("chosen"), F.count_distinct("dive").alias("dives"))
    return videos.groupBy("title").agg(F.count("*").alias("listed")).join(of, "title", "left").select("title", F.coalesce("chosen", F.lit(0)).alias("chosen"), "listed", F.coalesce("dives", F.lit(0)).alias("dives"))


def verb_totals(done: DataFrame) -> DataFrame:
    """One row over the reports that a verb went through: reports, animals, recordings judged, bytes before and after; failed ones don't count."""
    ok = F.col("error").isNull()
    add = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c)
    return done.agg(F.count("*").alias("reports"), F.count_if(~ok).alias("failed"), add("animals"), add("recordings"), add("bytes_before"), add("bytes_after"))


def mixed(published: DataFrame, new: DataFrame, by: list[str], key: str) -> DataFrame:
    """Published and new parts of each group, every part once, in order."""
    both = published.select(*by, key).unionByName(new.select(*by, key))
    return both.groupBy(*by).agg(F.array_sort(F.collect_set(key)).alias("parts"))


def taken_over(held: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """What is held, and of theirs each key that isn't, once."""
    return held.unionByName(theirs.dropDuplicates([key]).join(held.select(key), key, "left_anti"), allowMissingColumns=True)
