"""Queries along depth and time: composition, rates, accumulation, profiles, places."""

from __future__ import annotations

from pyspark.sql import functions as F

from benthos.functions.exprs import depth_bucket, time_bucket
from benthos.operators import analytics as an

from . import adapt
from .adapt import SLICES, TAXONOMY, with_sql
from .registry import query

STEP = """step AS (SELECT CASE WHEN hi - lo <= 0 THEN 500 WHEN (hi-lo)/1 <= 30 THEN 1 WHEN (hi-lo)/5 <= 30 THEN 5 WHEN (hi-lo)/10 <= 30 THEN 10 WHEN (hi-lo)/25 <= 30 THEN 25 WHEN (hi-lo)/50 <= 30 THEN 50
  WHEN (hi-lo)/100 <= 30 THEN 100 WHEN (hi-lo)/250 <= 30 THEN 250 ELSE 500 END AS step FROM (SELECT min(depth_m) AS lo, max(depth_m) AS hi FROM slices))"""
DEEP = "CAST(CAST(floor(depth_m / step) * step AS BIGINT) AS VARCHAR)"
UNIT = """unit AS (SELECT CASE WHEN n < 2 THEN 'day' WHEN d <= 2 THEN 'hour' WHEN d <= 120 THEN 'day' WHEN d <= 3650 THEN 'month' ELSE 'year' END AS unit
  FROM (SELECT count(DISTINCT CAST(recorded_at AS DATE)) AS n, date_diff('day', min(CAST(recorded_at AS DATE)), max(CAST(recorded_at AS DATE))) AS d FROM slices))"""
CLOCK = "CASE unit WHEN 'hour' THEN strftime(recorded_at, '%Y-%m-%d %H:00') WHEN 'day' THEN strftime(recorded_at, '%Y-%m-%d') WHEN 'month' THEN strftime(recorded_at, '%Y-%m') ELSE strftime(recorded_at, '%Y') END"


def _by_depth(spark, sf_dir):
    s = adapt.slices(spark, sf_dir)
    return s, depth_bucket(F.col("depth_m"), an.step_for_depth(s))


def _by_time(spark, sf_dir):
    s = adapt.slices(spark, sf_dir)
    return s, time_bucket(F.col("recorded_at"), an.unit_for_span(s, "recorded_at"))


@query(with_sql(SLICES, STEP) + f"SELECT {DEEP} AS bucket, detection_top_class AS taxon, expedition AS grp, round(coalesce(sum(detection_count), 0), 6) AS animals FROM slices, step GROUP BY 1, 2, 3")
def biodiversity_by_depth(spark, sf_dir):
    return an.cube(*_by_depth(spark, sf_dir)).withColumn("animals", F.round("animals", 6))


@query(with_sql(SLICES, UNIT) + f"SELECT {CLOCK} AS bucket, detection_top_class AS taxon, expedition AS grp, round(coalesce(sum(detection_count), 0), 6) AS animals FROM slices, unit GROUP BY 1, 2, 3")
def biodiversity_by_time(spark, sf_dir):
    return an.cube(*_by_time(spark, sf_dir)).withColumn("animals", F.round("animals", 6))


FOOTAGE = f"""foot AS (SELECT {{b}} AS bucket, sum((next_t - dim_t) / fps) AS seconds FROM (SELECT *, lead(dim_t) OVER (PARTITION BY name ORDER BY dim_t) AS next_t FROM slices), {{f}} WHERE next_t IS NOT NULL AND fps > 0 GROUP BY 1)"""


@query(with_sql(SLICES, STEP, FOOTAGE.format(b=DEEP, f="step")) + f"SELECT c.bucket, round(animals, 6) AS animals, round(seconds, 6) AS seconds, round(CASE WHEN seconds > 0 THEN animals / seconds END, 6) AS rate FROM (SELECT {DEEP} AS bucket, sum(detection_count) AS animals FROM slices, step GROUP BY 1) c LEFT JOIN foot ON foot.bucket = c.bucket")
def rate_by_depth(spark, sf_dir):
    s, b = _by_depth(spark, sf_dir)
    return an.rate(an.cube(s, b), an.footage_seconds(s, b)).select("bucket", *[F.round(c, 6).alias(c) for c in ("animals", "seconds", "rate")])


@query(with_sql(SLICES, STEP, FOOTAGE.format(b=DEEP, f="step")) + f"SELECT round(max(rate), 6) AS most, round(min(rate), 6) AS least, round(max(rate)/min(rate), 6) AS spread, max(rate)/min(rate) >= 1.5 AS varies FROM (SELECT animals / seconds AS rate FROM (SELECT {DEEP} AS bucket, sum(detection_count) AS animals FROM slices, step GROUP BY 1) c JOIN foot ON foot.bucket = c.bucket WHERE seconds > 0 AND animals > 0)")
def rate_spread(spark, sf_dir):
    s, b = _by_depth(spark, sf_dir)
    r = an.rate(an.cube(s, b), an.footage_seconds(s, b)).where("rate > 0")
    ratio = F.max("rate") / F.min("rate")
    return r.agg(F.round(F.max("rate"), 6).alias("most"), F.round(F.min("rate"), 6).alias("least"), F.round(ratio, 6).alias("spread"), (ratio >= 1.5).alias("varies"))


BANDED = f"""banded AS (SELECT {CLOCK} AS bucket, CASE WHEN detection_top_class IS NULL THEN 'Unnamed' WHEN class IS NOT NULL THEN class WHEN t.name IS NOT NULL THEN 'class unrecorded' ELSE 'Unplaced' END AS band, detection_count AS animals
  FROM slices s LEFT JOIN taxonomy t ON t.name = s.detection_top_class, unit WHERE detection_count > 0)"""


@query(with_sql(SLICES, UNIT, TAXONOMY, BANDED) + """SELECT bucket, band, round(sum(animals), 6) AS animals FROM (SELECT b.bucket, CASE WHEN r <= 2 THEN b.band ELSE concat(CAST(n - 2 AS VARCHAR), ' more') END AS band, animals FROM banded b
  JOIN (SELECT band, row_number() OVER (ORDER BY sum(animals) DESC, band) AS r, count(*) OVER () AS n FROM banded GROUP BY band) k ON k.band = b.band) GROUP BY 1, 2""")
def composition_by_time(spark, sf_dir):
    """Two bands are shown and the others folded, as the driver's taxonomy has few classes."""
    c = an.cube(*_by_time(spark, sf_dir))
    return an.composition(an.rank_of(adapt.taxonomy(spark, sf_dir), c, "class"), 2).withColumn("animals", F.round("animals", 6))


@query(with_sql(SLICES, UNIT) + f"""SELECT bucket, CAST(fresh AS BIGINT) AS fresh, CAST(sum(fresh) OVER (ORDER BY bucket) AS BIGINT) AS cumulative FROM (SELECT b.bucket, count(f.taxon) AS fresh FROM (SELECT DISTINCT {CLOCK} AS bucket FROM slices, unit) b
  LEFT JOIN (SELECT detection_top_class AS taxon, min({CLOCK}) AS bucket FROM slices, unit WHERE detection_top_class IS NOT NULL GROUP BY 1) f ON f.bucket = b.bucket GROUP BY 1)""")
def species_accumulation(spark, sf_dir):
    return an.accumulation(an.cube(*_by_time(spark, sf_dir)))


POINTS = """n AS (SELECT count(*) AS n FROM slices), points AS (
  SELECT rec, grp, min(stamp) AS stamp, avg(depth) AS depth FROM (SELECT name AS rec, expedition AS grp, epoch_us(recorded_at)/1000000.0::DOUBLE AS stamp, depth_m AS depth,
    CASE WHEN n > 4000 THEN CAST(floor(epoch_us(recorded_at)/1000000.0::DOUBLE / ceil(n/4000.0::DOUBLE)) AS BIGINT) ELSE row_number() OVER () END AS b FROM slices, n) GROUP BY rec, grp, b)"""


@query(with_sql(SLICES, POINTS) + "SELECT rec, grp, round(stamp, 3) AS stamp, round(depth, 6) AS depth FROM points")
def dive_profiles(spark, sf_dir):
    return an.profiles(adapt.slices(spark, sf_dir)).select("rec", "grp", F.round("stamp", 3).alias("stamp"), F.round("depth", 6).alias("depth"))


SESSIONS = """marks AS (SELECT *, lag(stamp) OVER w AS before, lag(rec) OVER w AS prev FROM points WINDOW w AS (ORDER BY stamp, rec)),
numbered AS (SELECT *, CASE WHEN before IS NULL OR stamp - before > {gap} THEN 1 ELSE 0 END AS new FROM marks),
dived AS (SELECT *, sum(new) OVER (ORDER BY stamp, rec ROWS UNBOUNDED PRECEDING) AS dive FROM numbered)"""


@query(with_sql(SLICES, POINTS, SESSIONS.format(gap=600)) + "SELECT CAST(dive AS BIGINT) AS dive, round(min(stamp), 3) AS start_stamp, count(*) AS points, count(*) FILTER (WHERE new = 1 OR rec <> prev) AS segments, round((max(stamp) - min(stamp)) / 3600, 6) AS hours FROM dived GROUP BY dive")
def dives(spark, sf_dir):
    """The driver's events are dense, so the gap that parts dives is ten minutes here."""
    d = an.dives(an.profiles(adapt.slices(spark, sf_dir)), 600 / 3600)
    return d.select("dive", F.round("start_stamp", 3).alias("start_stamp"), "points", "segments", F.round("hours", 6).alias("hours"))


@query(with_sql(SLICES) + "SELECT name AS rec, expedition AS grp, round(dim_t / nullif(fps, 0) / 60, 6) AS minutes, depth_m AS depth FROM slices")
def file_profiles(spark, sf_dir):
    return adapt.slices(spark, sf_dir).select(F.col("name").alias("rec"), F.col("expedition").alias("grp"), F.round(F.col("dim_t") / F.nullif("fps", F.lit(0.0)) / 60, 6).alias("minutes"), F.col("depth_m").alias("depth"))


@query(with_sql(SLICES) + "SELECT name, dim_t, round(depth_m - first_value(depth_m) OVER (PARTITION BY name ORDER BY dim_t), 6) AS change FROM slices")
def relative_depth(spark, sf_dir):
    return an.relative_depth(adapt.slices(spark, sf_dir)).withColumn("change", F.round("change", 6))


@query(with_sql(SLICES) + "SELECT round(list_sort(list(hi - lo))[CAST(floor(count(*)/2) AS INT)+1], 6) AS typical, round(max(hi - lo), 6) AS most, round(max(hi) - min(lo), 6) AS axis FROM (SELECT name, min(depth_m) AS lo, max(depth_m) AS hi FROM slices GROUP BY name)")
def profile_flatness(spark, sf_dir):
    return an.flatness(adapt.slices(spark, sf_dir)).select(*[F.round(c, 6).alias(c) for c in ("typical", "most", "axis")])


@query(with_sql(SLICES) + "SELECT name, round(count(*) * coalesce(median(gap), 1) / 30, 6) AS seconds FROM (SELECT *, dim_t - lag(dim_t) OVER (PARTITION BY name ORDER BY dim_t) AS gap FROM slices) GROUP BY name")
def footage_by_median_step(spark, sf_dir):
    return an.footage_by_median(adapt.slices(spark, sf_dir)).withColumn("seconds", F.round("seconds", 6))


PLACES = "places AS (SELECT concat('exp_', CAST(user_id % 5 AS VARCHAR)) AS grp, CAST((event_id*37 + user_id*911) % 1400 AS DOUBLE)/10 - 70 AS latitude, CAST((user_id * user_id * 131 + user_id % 7 * 50) % 2900 AS DOUBLE)/10 - 180 AS longitude FROM events)"


def _places(spark, sf_dir):
    u, e = F.col("user_id"), F.col("event_id")
    return adapt.read(spark, sf_dir, "events").select(F.concat(F.lit("exp_"), (u % 5).cast("string")).alias("grp"), (((e * 37 + u * 911) % 1400).cast("double") / 10 - 70).alias("latitude"), (((u * u * 131 + u % 7 * 50) % 2900).cast("double") / 10 - 180).alias("longitude"))


@query(with_sql(PLACES) + """, mean AS (SELECT grp, avg(latitude) AS latitude, degrees(atan2(sum(sin(radians(longitude))), sum(cos(radians(longitude))))) AS mean_longitude FROM places GROUP BY grp),
gaps AS (SELECT grp, longitude AS east, coalesce(nxt, lo) AS west, coalesce(nxt, lo + 360) - longitude AS gap FROM (SELECT grp, longitude, lead(longitude) OVER (PARTITION BY grp ORDER BY longitude) AS nxt, min(longitude) OVER (PARTITION BY grp) AS lo FROM (SELECT DISTINCT grp, longitude FROM places))),
edge AS (SELECT grp, max({'gap': gap, 'east': east, 'west': west}) AS g FROM gaps GROUP BY grp)
SELECT mean.grp, round(latitude, 6) AS latitude, round(mean_longitude, 6) AS mean_longitude, g.west AS west, g.east AS east, round(360 - g.gap, 6) AS width FROM mean JOIN edge ON edge.grp = mean.grp""")
def placed(spark, sf_dir):
    p = an.placed(_places(spark, sf_dir), ["grp"])
    return p.select("grp", F.round("latitude", 6).alias("latitude"), F.round("mean_longitude", 6).alias("mean_longitude"), "west", "east", F.round("width", 6).alias("width"))


@query(with_sql(SLICES) + """, x AS (SELECT name, frame_difference AS v, row_number() OVER (PARTITION BY name ORDER BY dim_t) - 1 AS i, count(*) OVER (PARTITION BY name) AS N FROM slices),
b AS (SELECT name, N, unnest(range(240)) AS band FROM (SELECT DISTINCT name, N FROM x)),
r AS (SELECT name, band, CAST(floor(band * N / 240.0::DOUBLE) AS BIGINT) AS a, greatest(CAST(floor((band + 1) * N / 240.0::DOUBLE) AS BIGINT), CAST(floor(band * N / 240.0::DOUBLE) AS BIGINT) + 1) AS z FROM b)
SELECT r.name, CAST(band AS BIGINT) AS band, round(avg(v), 6) AS movement FROM r JOIN x ON x.name = r.name AND x.i >= a AND x.i < z GROUP BY 1, 2""")
def stripe_bands(spark, sf_dir):
    b = an.bands(adapt.slices(spark, sf_dir), "frame_difference")
    return b.select("name", F.col("band").cast("bigint").alias("band"), F.round("frame_difference", 6).alias("movement"))


@query(with_sql(SLICES) + "SELECT name, row_number() OVER (ORDER BY first_at, name) AS pos FROM (SELECT name, min(recorded_at) AS first_at FROM slices GROUP BY name)")
def recording_order(spark, sf_dir):
    from pyspark.sql import Window

    g = adapt.slices(spark, sf_dir).groupBy("name").agg(F.min("recorded_at").alias("first_at"))
    return g.select("name", F.row_number().over(Window.orderBy("first_at", "name")).cast("bigint").alias("pos"))  # a row for each recording


HITS = "hits AS (SELECT name, dim_t / fps AS second FROM slices WHERE detection_count > 0)"
HIT_WINDOWS = """hw AS (SELECT name, min(second) AS start, max(second) AS stop FROM (SELECT *, sum(new) OVER (PARTITION BY name ORDER BY second) AS n FROM (
  SELECT *, CASE WHEN second - lag(second) OVER (PARTITION BY name ORDER BY second) <= 4 THEN 0 ELSE 1 END AS new FROM hits)) GROUP BY name, n)"""


def _hits(spark, sf_dir):
    return an.hit_windows(adapt.slices(spark, sf_dir).where("detection_count > 0").select("name", (F.col("dim_t") / F.col("fps")).alias("second")))


@query(with_sql(SLICES, HITS, HIT_WINDOWS) + "SELECT * FROM hw")
def hit_windows(spark, sf_dir):
    return _hits(spark, sf_dir)


@query(with_sql(SLICES, HITS, HIT_WINDOWS) + """SELECT DISTINCT name, unnest(range(a - a % 6, z + 1, 6)) AS frame FROM (SELECT name, CAST(floor(greatest(0, start - 2) * 30) AS BIGINT) AS a, CAST(floor(least(100000, stop + 2) * 30) AS BIGINT) AS z FROM hw)""")
def frames_to_visit(spark, sf_dir):
    return an.frames_to_visit(_hits(spark, sf_dir), 30.0, 2.0, 100000.0, 6)
