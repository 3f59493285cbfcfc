"""Whole-report passes: identify, judge, combine, slim, score. Each takes and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benthos import schema
from benthos.functions.exprs import expedition_label
from benthos.operators import joins, link, triage
from benthos.sources.parts import unify

#: Columns that only hold pictures (fixed by the report layout).
PICTURES = ("slice_thumbnail", "detection_crop")


def sightings(report: DataFrame) -> DataFrame:
    """One row a detection that isn't a clip frame; `pos` is its place in the slice's list, `ord` the stable order."""
    e = F.posexplode(schema.detections(F.col("detections")))
    d = report.where("detections is not null and dim_t is not null").select(F.col("name").alias("recording"), F.col("dim_t").alias("slice_t"), "fps", e.alias("pos", "d"))
    d = d.where(~schema.is_clip(F.col("d")))
    second = F.coalesce("d.second", F.col("d.frame") / F.when(F.col("fps") != 0, F.col("fps")), F.col("slice_t") / F.when(F.col("fps") != 0, F.col("fps")).otherwise(1.0))
    box = [F.coalesce(F.get("d.box", i), F.lit(0)).alias(c) for i, c in enumerate(link.BOX)]
    return d.select("recording", "slice_t", "pos", second.alias("second"), F.col("d.frame").alias("frame"), F.coalesce("d.class", F.lit("")).alias("taxon"), F.coalesce("d.conf", F.lit(0.0)).alias("confidence"), *box, F.concat_ws("|", F.lpad(F.col("slice_t").cast("string"), 12, "0"), F.lpad(F.col("pos").cast("string"), 6, "0")).alias("ord"), F.col("d.animal").alias("stored"))


def identify(report: DataFrame, lineages: DataFrame) -> DataFrame:
    """The report with an animal, its name and agreement on every detection; clip frames take their animal's.

    Run again it gives the same ids.
    """
    t = link.track(sightings(report).drop("stored", "frame"))
    n = link.named(t, lineages)
    ids = t.join(n.withColumnRenamed("taxon", "animal_taxon"), ["recording", "animal"]).groupBy(F.col("recording").alias("_r"), F.col("slice_t").alias("_t")).agg(F.map_from_entries(F.collect_list(F.struct("pos", F.struct(F.col("animal").cast("int").alias("animal"), "animal_taxon", F.col("agreement").alias("animal_agreement"))))).alias("_ids"))
    j = report.join(ids, (F.col("name") == F.col("_r")) & (F.col("dim_t") == F.col("_t")), "left")
    entries = schema.detections(F.col("detections"))
    real = F.filter(F.sequence(F.lit(0), F.size("_e") - 1), lambda i: ~schema.is_clip(F.get("_e", i)))
    of = lambda d, i: F.when(schema.is_clip(d), F.get("_real", d["of"])).otherwise(i)

    def tag(d, i):
        got = F.try_element_at("_ids", of(d, i))
        keep = [d[f.split(":")[0].strip()].alias(f.split(":")[0].strip()) for f in schema.DETECTION[len("array<struct<") : -2].replace("array<int>", "list").split(",") if not f.strip().startswith("animal")]
        return F.struct(*keep, F.coalesce(got["animal"], d["animal"]).alias("animal"), F.coalesce(got["animal_taxon"], d["animal_taxon"]).alias("animal_taxon"), F.coalesce(got["animal_agreement"], d["animal_agreement"]).alias("animal_agreement"))

    tagged = j.withColumn("_e", entries).withColumn("_real", F.when(F.size("_e") > 0, real)).withColumn("_new", F.transform("_e", tag))
    return tagged.withColumn("detections", F.when(F.size("_e") > 0, F.to_json("_new")).otherwise(F.col("detections"))).select(*report.columns)


def has_ids(report: DataFrame) -> bool:
    return report.where(F.exists(schema.detections(F.col("detections")), lambda d: d["animal"].isNotNull())).limit(1).count() > 0


def rebuilt(sights: DataFrame) -> DataFrame:
    """sights with `animal` from the stored ids where a recording has one on every sighting, else null."""
    w = Window.partitionBy("recording")
    return sights.withColumn("animal", F.when(F.min(F.col("stored").isNotNull()).over(w), F.col("stored").cast("bigint")))


def judge(report: DataFrame) -> DataFrame:
    """The report with its verdict columns; only rows at the slice grain are judged."""
    r = schema.ensure(report)
    line = triage.timeline(schema.slices(r), "laplacian_variance" if "laplacian_variance" in report.columns else "std_intensity")
    return triage.describe(report, triage.verdicts(line))


def combine(parts: dict[str, DataFrame], catalogue: DataFrame) -> DataFrame:
    """All expeditions in one table without pictures, labelled for an axis. parts: id -> report."""
    tagged = [p.drop(*PICTURES).withColumn("_id", F.lit(i)) for i, p in parts.items()]
    all_ = unify(tagged)
    names = catalogue.select(F.col("id").alias("_c"), expedition_label(F.coalesce("title", "id"), F.col("date")).alias("_label"))
    out = all_.join(names, F.col("_id") == F.col("_c"), "left")
    return out.withColumn("expedition", F.coalesce("_label", "_id")).drop("_id", "_c", "_label")


def slim(report: DataFrame) -> DataFrame:
    """The report without its duplicated pictures; a second run changes nothing."""
    return report.drop(*PICTURES)


def without_clips(report: DataFrame) -> DataFrame:
    e = schema.without_clips(schema.detections(F.col("detections")))
    return report.withColumn("detections", schema.to_text(e))


def progress(report: DataFrame) -> DataFrame:
    """One row for the collection's table: recordings, slices, animals, sightings, taxa."""
    s = sightings(report)
    t = link.animals(link.track(s.drop("stored", "frame"))).where(link.is_animal(F.col("best_taxon")))
    return t.agg(F.count_if(~F.col("vehicle")).alias("animals"), F.count_if("vehicle").alias("vehicle"), F.sum("frames").alias("sightings"), F.sort_array(F.collect_set("best_taxon")).alias("taxa"))


def scored(report: DataFrame, truth: DataFrame, first: int = 1, min_iou: float = link.MATCH_IOU) -> tuple[DataFrame, DataFrame]:
    """(scores, judged): a report's detections against annotated boxes (recording, frame, track, ord, x1..y2).

    A detection is judged on the annotated frame nearest to its second, and only there; each box is claimed once.
    """
    rate = report.groupBy(F.col("name").alias("recording")).agg(F.max("fps").alias("fps"))
    found = sightings(report).drop("stored", "frame").join(rate, "recording")
    found = found.select("recording", "second", F.col("confidence").alias("conf"), "ord", *link.BOX, "fps")
    at = joins.nearest_frame(found, truth, ["recording"], F.col("fps"), first)
    judged = link.match_truth(at, truth, ["recording", "frame"], min_iou)
    seen = judged.select("recording", "frame").distinct()
    looked = truth.join(seen, ["recording", "frame"], "left_semi").groupBy("recording").agg(F.count("*").alias("truth_boxes"))
    whole = truth.groupBy("recording").agg(F.count("*").alias("truth_boxes_all"), F.count_distinct("track").alias("animals_all"), F.count_distinct("frame").alias("frames_annotated"))
    hits = judged.groupBy("recording").agg(F.count("*").alias("detections"), F.count("landed_on").alias("matched"), F.count_distinct("landed_on").alias("animals_found"), F.count_distinct("frame").alias("frames_judged"))
    x = whole.join(looked, "recording", "left").join(hits, "recording", "left").fillna(0, ["truth_boxes", "detections", "matched", "animals_found", "frames_judged"])
    part = lambda a, b: F.try_divide(F.col(a), F.nullif(F.col(b), F.lit(0)))
    return x.withColumns({"precision": part("matched", "detections"), "recall": part("matched", "truth_boxes"), "recall_overall": part("matched", "truth_boxes_all"), "recall_animals": part("animals_found", "animals_all"), "looked_at": part("frames_judged", "frames_annotated")}), judged


def built(report: DataFrame, lineages: DataFrame) -> DataFrame:
    """A merged report made ready to read: without clip frames, its individuals named, its slices judged."""
    return judge(identify(without_clips(report), lineages))


def jobs_that_fit(asked: int, free_gb: float, each_gb: float = 6.0) -> int:
    """As many recordings at once as there is memory for, one at least, never more than asked."""
    return max(1, min(asked, int(free_gb / each_gb)))
