"""Queries over timelines: verdicts, runs, windows, recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benthos.operators import triage

from . import adapt
from .adapt import SLICES, with_sql
from .registry import query

_NR = "coalesce(list_sort(list({x}) FILTER (WHERE {c}))[CAST(least(count(*) FILTER (WHERE {c}) - 1, floor({p}::DOUBLE*count(*) FILTER (WHERE {c}))) AS INT)+1], 0.0)"
THRESHOLDS = f"""th AS (SELECT name,
  {_NR.format(x="frame_difference", c="frame_difference >= 0.01", p="0.15")} AS dwell_below,
  {_NR.format(x="frame_difference", c="true", p="0.90")} AS active_above,
  {_NR.format(x="std_intensity", c="std_intensity IS NOT NULL", p="0.5")} AS detail
  FROM slices GROUP BY name)"""
JUDGED = """judged AS (SELECT s.name, dim_t AS t, frame_difference AS movement, std_intensity AS structure, detection_count AS detections, detection_top_class AS top_class,
  detection_confidence AS confidence, fps,
  CASE WHEN frame_difference < 0.01 THEN 'frozen' WHEN detection_count > 0 THEN 'subject' WHEN moving_object_count > 0 THEN 'unnamed'
       WHEN frame_difference <= dwell_below THEN CASE WHEN detail > 0 AND std_intensity < detail*0.2::DOUBLE THEN 'empty' ELSE 'dwell' END
       WHEN frame_difference >= active_above THEN 'active' END AS verdict
  FROM slices s JOIN th ON th.name = s.name)"""
RUNS = """placed_at AS (SELECT name, t, verdict AS kind, CASE WHEN verdict='subject' THEN coalesce(top_class,'') END AS label, row_number() OVER (PARTITION BY name ORDER BY t) - 1 AS i FROM judged),
fresh AS (SELECT *, CASE WHEN i = 0 OR lag(kind) OVER w IS DISTINCT FROM kind OR lag(label) OVER w IS DISTINCT FROM label THEN 1 ELSE 0 END AS new FROM placed_at WINDOW w AS (PARTITION BY name ORDER BY t)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY name ORDER BY t) AS run FROM fresh),
runs AS (SELECT name, kind, label, min(i) AS s, max(i) AS e FROM numbered WHERE kind IS NOT NULL GROUP BY name, run, kind, label)"""
WINDOWS = """ordered AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY s) AS idx FROM runs),
fold AS (
  SELECT name, 0::BIGINT AS idx, []::STRUCT(s BIGINT, e BIGINT, k VARCHAR, l VARCHAR)[] AS m FROM (SELECT DISTINCT name FROM runs)
  UNION ALL
  SELECT name, idx, CASE WHEN hit > stop THEN list_transform(m, lambda x, i: CASE WHEN i = hit THEN {'s': x.s, 'e': greatest(x.e, e), 'k': x.k, 'l': x.l} ELSE x END)
                    ELSE list_append(m, {'s': s, 'e': e, 'k': kind, 'l': label}) END
  FROM (SELECT f.name, r.idx, f.m, r.s, r.e, r.kind, r.label,
          coalesce(list_max(list_transform(f.m, lambda x, i: CASE WHEN x.k = r.kind AND x.l IS NOT DISTINCT FROM r.label THEN i ELSE 0 END)), 0) AS hit,
          coalesce(list_max(list_transform(f.m, lambda x, i: CASE WHEN r.s - x.e - 1 > 10 THEN i ELSE 0 END)), 0) AS stop
        FROM fold f JOIN ordered r ON r.name = f.name AND r.idx = f.idx + 1)),
final AS (SELECT name, arg_max(m, idx) AS m FROM fold GROUP BY name),
wins AS (SELECT name, x.k AS kind, x.l AS label, x.s AS s, x.e AS e FROM (SELECT name, unnest(m) AS x FROM final) WHERE x.k = 'subject' OR x.e - x.s + 1 >= 2)"""
_J = [SLICES, THRESHOLDS, JUDGED]


def rec_sql(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.verdicts(triage.timeline(adapt.slices(spark, sf_dir)))


@query(with_sql(SLICES, THRESHOLDS) + "SELECT * FROM th")
def verdict_thresholds(spark, sf_dir):
    return triage.thresholds(triage.timeline(adapt.slices(spark, sf_dir)))


@query(with_sql(*_J) + "SELECT name, t, verdict FROM judged")
def slice_verdicts(spark, sf_dir):
    return _judged(spark, sf_dir).select("name", "t", "verdict")


_SEC = ", ".join(f"round(count(*) FILTER (WHERE verdict='{v}') * step / fps, 6) AS verdict_seconds_{v}" for v in triage.VERDICTS)


@query(with_sql(*_J) + f"SELECT name, round(count(*) * step / fps, 6) AS footage_seconds, {_SEC} FROM (SELECT *, 30::DOUBLE AS step0, coalesce(nth_value(t, 2) OVER (PARTITION BY name ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - min(t) OVER (PARTITION BY name), 1) AS step FROM judged) GROUP BY name, step, fps")
def verdict_seconds(spark, sf_dir):
    s = triage.seconds(_judged(spark, sf_dir))
    return s.select("name", *[F.round(c, 6).alias(c) for c in s.columns[1:]])


@query(with_sql(*_J, RUNS) + "SELECT name, kind, label, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM runs")
def verdict_runs(spark, sf_dir):
    return triage.runs(_judged(spark, sf_dir)).select("name", "kind", "label", F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))


@query(rec_sql(*_J, RUNS, WINDOWS) + "SELECT name, kind, label, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM wins")
def verdict_windows(spark, sf_dir):
    return triage.windows(_judged(spark, sf_dir)).select("name", "kind", "label", F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))


EVENTS = """events_ AS (SELECT w.name, w.kind, w.label, CAST(w.s AS BIGINT) AS s, CAST(w.e - w.s + 1 AS BIGINT) AS slices, min(a.t) AS from_t, max(a.t) AS to_t, avg(a.movement) AS movement, avg(a.detections) AS detections,
  max(a.confidence) AS confidence, coalesce(nullif(w.label, ''), arg_max(a.top_class, {'b': coalesce(a.confidence, a.detections), 'i': -a.i}) FILTER (WHERE a.top_class IS NOT NULL)) AS top_class
  FROM wins w JOIN (SELECT *, row_number() OVER (PARTITION BY name ORDER BY t) - 1 AS i FROM judged) a ON a.name = w.name AND a.i BETWEEN w.s AND w.e GROUP BY w.name, w.kind, w.label, w.s, w.e)"""
SCORED = """scored AS (SELECT v.*, abs(log2((v.movement + 0.001::DOUBLE) / b.median)) * log2(1 + slices) AS score FROM events_ v
  JOIN (SELECT name, list_sort(list(movement))[CAST(least(count(*)-1, floor(0.5::DOUBLE*count(*))) AS INT)+1] AS median FROM judged GROUP BY name) b ON b.name = v.name)"""
_E = [*_J, RUNS, WINDOWS, EVENTS]
_COLS = "name, kind, label, s, slices, CAST(from_t AS BIGINT) AS from_t, CAST(to_t AS BIGINT) AS to_t, round(movement + 1e-9::DOUBLE, 6) AS movement, round(detections + 1e-9::DOUBLE, 6) AS detections, confidence, top_class"


def _events(spark, sf_dir):
    j = _judged(spark, sf_dir)
    return j, triage.described(j, triage.windows(j))


def _shown(df: DataFrame, *more):
    return df.select("name", "kind", "label", F.col("s").cast("bigint").alias("s"), F.col("slices").cast("bigint").alias("slices"), F.col("from_t").cast("bigint").alias("from_t"), F.col("to_t").cast("bigint").alias("to_t"), F.round(F.col("movement") + 1e-9, 6).alias("movement"), F.round(F.col("detections") + 1e-9, 6).alias("detections"), "confidence", "top_class", *more)


@query(rec_sql(*_E) + f"SELECT {_COLS} FROM events_")
def event_rows(spark, sf_dir):
    return _shown(_events(spark, sf_dir)[1])


@query(rec_sql(*_E, SCORED) + f"SELECT {_COLS}, round(score, 6) AS score FROM scored")
def event_scores(spark, sf_dir):
    j, e = _events(spark, sf_dir)
    return _shown(triage.interest(e, j), F.round("score", 6).alias("score"))


@query(rec_sql(*_E, SCORED) + "SELECT name, kind, s, round(score, 6) AS score FROM scored WHERE (kind = 'subject' OR slices >= 2) AND (coalesce(confidence >= 0.2, kind <> 'subject')) ORDER BY round(score, 6) DESC, name, s, kind, coalesce(label, '') LIMIT 48")
def event_gallery(spark, sf_dir):
    """The feature is a page of the 48 most interesting events above the quality floor."""
    j, e = _events(spark, sf_dir)
    x = triage.interest(e, j).withColumn("score", F.round("score", 6))
    kept = x.where(((F.col("kind") == "subject") | (F.col("slices") >= 2)) & F.coalesce(F.col("confidence") >= 0.2, F.col("kind") != "subject"))
    return kept.orderBy(F.desc("score"), "name", "s", "kind", F.coalesce("label", F.lit(""))).limit(48).select("name", "kind", F.col("s").cast("bigint").alias("s"), "score")


@query(rec_sql(*_E) + "SELECT count(*) AS events, count(DISTINCT name) AS recordings, count(*) FILTER (WHERE kind = 'subject') AS with_animals, count(DISTINCT top_class) FILTER (WHERE kind='subject') AS taxa FROM events_")
def event_headline(spark, sf_dir):
    subject = F.col("kind") == "subject"
    return _events(spark, sf_dir)[1].agg(F.count("*").alias("events"), F.count_distinct("name").alias("recordings"), F.count_if(subject).alias("with_animals"), F.count_distinct(F.when(subject, F.col("top_class"))).alias("taxa"))


@query(rec_sql(*_E) + "SELECT top_class AS taxon, count(*) AS events FROM events_ WHERE kind='subject' GROUP BY 1")
def taxon_event_counts(spark, sf_dir):
    return _events(spark, sf_dir)[1].where("kind = 'subject'").groupBy(F.col("top_class").alias("taxon")).agg(F.count("*").alias("events"))


@query(with_sql(SLICES) + "SELECT name, count(*) AS slices, max(fps) AS fps, max(expedition) AS grp FROM slices WHERE obs_level = 1 GROUP BY name")
def recordings_listing(spark, sf_dir):
    return adapt.slices(spark, sf_dir).where("obs_level = 1").groupBy("name").agg(F.count("*").alias("slices"), F.max("fps").alias("fps"), F.max("expedition").alias("grp"))


@query(with_sql(*_J) + "SELECT name, verdict, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY name), 6) AS share FROM judged GROUP BY name, verdict")
def verdict_share(spark, sf_dir):
    from pyspark.sql import Window

    n = _judged(spark, sf_dir).groupBy("name", "verdict").count()
    return n.select("name", "verdict", F.round(F.lit(100.0) * F.col("count") / F.sum("count").over(Window.partitionBy("name")), 6).alias("share"))


@query(with_sql(*_J) + "SELECT round(count(*) * 1.0::DOUBLE, 6) AS total, round(count(*) FILTER (WHERE verdict='frozen') * 1.0::DOUBLE, 6) AS dead, round(count(*) FILTER (WHERE verdict='dwell') * 1.0::DOUBLE, 6) AS held, round(count(*) FILTER (WHERE verdict='frozen') * 1.0::DOUBLE / count(*), 6) AS dead_share FROM judged")
def verdict_headline(spark, sf_dir):
    s = triage.seconds(_judged(spark, sf_dir))
    return s.agg(F.round(F.sum("footage_seconds"), 6).alias("total"), F.round(F.sum("verdict_seconds_frozen"), 6).alias("dead"), F.round(F.sum("verdict_seconds_dwell"), 6).alias("held"), F.round(F.sum("verdict_seconds_frozen") / F.sum("footage_seconds"), 6).alias("dead_share"))


@query(with_sql(SLICES) + "SELECT expedition AS grp, count(frame_difference) AS movement, count(detection_top_class) AS named, count(detection_confidence) AS confidence, count(*) FILTER (WHERE detection_count > 0) AS with_animals FROM slices GROUP BY 1")
def measured_counts(spark, sf_dir):
    return adapt.slices(spark, sf_dir).groupBy(F.col("expedition").alias("grp")).agg(F.count("frame_difference").alias("movement"), F.count("detection_top_class").alias("named"), F.count("detection_confidence").alias("confidence"), F.count_if(F.col("detection_count") > 0).alias("with_animals"))


@query(with_sql(SLICES) + "SELECT expedition AS grp, round(quantile_cont(frame_difference, 0.25), 6) AS q1, round(quantile_cont(frame_difference, 0.5), 6) AS median, round(quantile_cont(frame_difference, 0.75), 6) AS q3, min(frame_difference) AS low, max(frame_difference) AS high FROM slices GROUP BY 1")
def movement_distribution(spark, sf_dir):
    p = lambda q: F.round(F.percentile("frame_difference", F.lit(q)), 6)
    return adapt.slices(spark, sf_dir).groupBy(F.col("expedition").alias("grp")).agg(p(0.25).alias("q1"), p(0.5).alias("median"), p(0.75).alias("q3"), F.min("frame_difference").alias("low"), F.max("frame_difference").alias("high"))


@query(with_sql(SLICES) + "SELECT count(DISTINCT name) AS recordings, count(*) AS slices, count(*) FILTER (WHERE detection_count > 0) AS with_animals, count(DISTINCT detection_top_class) AS taxa, min(recorded_at) AS first_at, max(recorded_at) AS last_at, min(depth_m) AS shallowest, max(depth_m) AS deepest FROM slices")
def report_summary(spark, sf_dir):
    return adapt.slices(spark, sf_dir).agg(F.count_distinct("name").alias("recordings"), F.count("*").alias("slices"), F.count_if(F.col("detection_count") > 0).alias("with_animals"), F.count_distinct("detection_top_class").alias("taxa"), F.min("recorded_at").alias("first_at"), F.max("recorded_at").alias("last_at"), F.min("depth_m").alias("shallowest"), F.max("depth_m").alias("deepest"))


@query(with_sql(SLICES) + "SELECT detection_top_class AS taxon, name, dim_t, detection_confidence AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY detection_top_class ORDER BY detection_confidence DESC NULLS LAST, name, dim_t) AS r FROM slices WHERE detection_top_class IS NOT NULL) WHERE r = 1")
def best_look_per_taxon(spark, sf_dir):
    best = F.min(F.struct((-F.col("detection_confidence")).alias("c"), "name", "dim_t"))
    g = adapt.slices(spark, sf_dir).where("detection_top_class is not null").groupBy(F.col("detection_top_class").alias("taxon")).agg(best.alias("b"))
    return g.select("taxon", F.col("b.name").alias("name"), F.col("b.dim_t").alias("dim_t"), (-F.col("b.c")).alias("confidence"))
