"""Queries over what the page shows: stills, strides, boxes, shares, captions, colours."""

from __future__ import annotations

from pyspark.sql import functions as F

from benthos.operators import choices, link, triage
from benthos.operators import gallery as g

from . import adapt
from .adapt import SIGHTINGS, SLICES, TAXONOMY, read, with_sql
from .registry import query
from .timelines import _E, _J, _events, rec_sql

STEP = "CASE WHEN slices > 1 THEN greatest(CAST(floor((to_t - from_t) / (slices - 1) + 0.5) AS BIGINT), 1) ELSE 1 END"


@query(rec_sql(*_E) + f"SELECT name, s, kind, coalesce(label, '') AS label, t FROM (SELECT name, s, kind, label, unnest(list_slice(list_transform(range(0, slices, greatest(1, CAST(floor(slices / 6.0::DOUBLE + 0.5) AS BIGINT))), lambda i: CAST(from_t + i * ({STEP}) AS BIGINT)), 1, 6)) AS t FROM events_)")
def still_times(spark, sf_dir):
    """The feature is at most six stills an event."""
    e = _events(spark, sf_dir)[1].withColumn("slices", F.col("slices").cast("bigint"))
    return g.still_times(e).select("name", F.col("s").cast("bigint").alias("s"), "kind", F.coalesce("label", F.lit("")).alias("label"), "t")


@query(with_sql(SIGHTINGS) + "SELECT ord FROM (SELECT *, row_number() OVER (PARTITION BY recording, taxon ORDER BY second, ord) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY recording, taxon) // 6) AS k FROM sightings) WHERE i % k = 0 AND i / k < 6")
def strided_frames(spark, sf_dir):
    """The feature is six frames of each tile."""
    return g.strided(adapt.sightings(spark, sf_dir), ["recording", "taxon"], ["second", "ord"], 6).select("ord")


@query(with_sql(SIGHTINGS) + "SELECT ord FROM (SELECT *, count(*) OVER (PARTITION BY recording, second) > 1 AND min(CAST(is_truth AS INT)) OVER (PARTITION BY recording, second) = 1 AS steady, row_number() OVER (PARTITION BY recording, second ORDER BY confidence DESC, ord) AS b FROM sightings) WHERE steady OR b = 1")
def frames_to_play(spark, sf_dir):
    s = adapt.sightings(spark, sf_dir).withColumnRenamed("confidence", "conf").withColumn("clip", F.col("is_truth"))
    return g.to_play(s, ["recording", "second"]).select("ord")


LOOKS = "looks AS (SELECT recording, taxon, second, arg_min(x1, ord) AS x1, arg_min(y1, ord) AS y1, arg_min(x2, ord) AS x2, arg_min(y2, ord) AS y2 FROM sightings GROUP BY ALL), k AS (SELECT concat(recording, taxon) AS key, second, x1, y1, x2, y2 FROM looks), m AS (SELECT DISTINCT key, second + 0.4 AS now FROM k)"


@query(with_sql(SIGHTINGS, LOOKS) + """, j AS (SELECT m.key, m.now, b.second AS bs, b.x1 AS bx, a.second AS s2, a.x1 AS ax FROM m ASOF LEFT JOIN k b ON m.key = b.key AND m.now > b.second ASOF LEFT JOIN k a ON m.key = a.key AND m.now <= a.second)
SELECT key, round(now, 3) AS now, round(CASE WHEN s2 IS NULL THEN CASE WHEN now <= bs + 0.7::DOUBLE THEN bx END WHEN bs IS NULL THEN CASE WHEN now >= s2 - 0.7::DOUBLE THEN ax END
  WHEN s2 - bs > 2.5 THEN CASE WHEN now - bs <= 0.7::DOUBLE THEN bx WHEN s2 - now <= 0.7::DOUBLE THEN ax END ELSE bx + (ax - bx) * CASE WHEN s2 > bs THEN (now - bs) / (s2 - bs) ELSE 0 END END + 1e-7::DOUBLE, 4) AS x1 FROM j""")
def box_between_looks(spark, sf_dir):
    first = lambda c: F.min(F.struct("ord", c))[c].alias(c)
    k = adapt.sightings(spark, sf_dir).groupBy(F.concat("recording", "taxon").alias("key"), "second").agg(*[first(c) for c in link.BOX])
    b = g.box_at(k, k.select("key", (F.col("second") + 0.4).alias("now")), "key")
    return b.select("key", F.round("now", 3).alias("now"), F.round(F.col("x1") + 1e-7, 4).alias("x1"))


@query(with_sql(SIGHTINGS) + """SELECT recording, second, taxon, found FROM (SELECT a.recording, a.second, a.taxon, b.ord AS found, row_number() OVER (PARTITION BY a.recording, a.second, a.taxon ORDER BY (a.taxon <> b.taxon), b.ord) AS r
  FROM (SELECT DISTINCT recording, second, taxon FROM sightings WHERE is_truth) a JOIN sightings b ON a.recording = b.recording AND abs(a.second - b.second) < 0.06 AND NOT b.is_truth) WHERE r = 1""")
def shares_found_again(spark, sf_dir):
    s = adapt.sightings(spark, sf_dir)
    return g.found_again(s.where("is_truth").select("recording", "second", "taxon").distinct(), s.where("not is_truth"))


@query(with_sql(SIGHTINGS) + "SELECT taxon, page, row_number() OVER (ORDER BY page, taxon) - 1 AS n FROM (SELECT taxon, unnest(range(0, CAST(ceil(count(*) / 60.0) AS BIGINT))) AS page FROM sightings GROUP BY taxon)")
def pages_interleaved(spark, sf_dir):
    p = adapt.sightings(spark, sf_dir).groupBy("taxon").agg(F.ceil(F.count("*") / 60).cast("bigint").alias("pages")).withColumn("pos", F.col("taxon"))
    return g.interleaved(p).select("taxon", "page", F.col("n").cast("bigint").alias("n"))


@query(with_sql(SIGHTINGS) + "SELECT ord, greatest(0, x1 - CAST(trunc((x2-x1)*0.6::DOUBLE) AS INT) - 8) AS a, greatest(0, y1 - CAST(trunc((y2-y1)*0.6::DOUBLE) AS INT) - 8) AS b, least(640, x2 + CAST(trunc((x2-x1)*0.6::DOUBLE) AS INT) + 8) AS c, least(360, y2 + CAST(trunc((y2-y1)*0.6::DOUBLE) AS INT) + 8) AS d FROM sightings")
def crop_windows(spark, sf_dir):
    s = adapt.sightings(spark, sf_dir).withColumn("w", g.crop_window([F.col(c) for c in link.BOX], 640, 360))
    return s.select("ord", *[F.get("w", i).alias(n) for i, n in enumerate("abcd")])


@query("""SELECT p_partkey, CAST(CASE WHEN wanted <= 1 THEN 1 ELSE len(list_distinct(list_transform(range(0, wanted), lambda i: least(n - 1, CAST(floor((i + 0.5::DOUBLE) * (n / wanted::DOUBLE)) AS BIGINT))))) END AS BIGINT) AS looks,
CAST(CASE WHEN wanted <= 1 THEN greatest(0, (n - 1) // 2) ELSE least(n - 1, CAST(floor(0.5::DOUBLE * (n / wanted::DOUBLE)) AS BIGINT)) END AS BIGINT) AS first FROM (SELECT p_partkey, p_size * 7 AS n, greatest(1, CAST(round_even(p_size * 7 / 30.0::DOUBLE, 0) AS BIGINT)) AS wanted FROM part)""")
def moments_to_read(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("m", g.moments_to_read((F.col("p_size") * 7).cast("int"), F.lit(30.0)))
    return p.select("p_partkey", F.size("m").cast("bigint").alias("looks"), F.get("m", 0).cast("bigint").alias("first"))


@query(with_sql(SIGHTINGS) + """SELECT recording, taxon, concat('Detector guess: ', taxon, ' · ', recording, ' · ', lpad(CAST(s // 3600 AS VARCHAR),2,'0'), ':', lpad(CAST((s // 60) % 60 AS VARCHAR),2,'0'), ':', lpad(CAST(s % 60 AS VARCHAR),2,'0'), ' · ', CAST(CAST(floor(c*100+0.5) AS BIGINT) AS VARCHAR), '% certainty · ', CAST(n AS VARCHAR), ' frame', CASE WHEN n = 1 THEN '' ELSE 's' END) AS caption, CASE WHEN d >= 0.05::DOUBLE THEN concat(printf('%.1f', floor(d*10+0.5)/10), 's') ELSE '·' END AS held
FROM (SELECT recording, taxon, CAST(floor(min(second)+0.5) AS BIGINT) AS s, max(confidence) AS c, count(*) AS n, max(second) - min(second) AS d FROM sightings GROUP BY 1, 2)""")
def tile_captions(spark, sf_dir):
    t = adapt.sightings(spark, sf_dir).groupBy("recording", "taxon").agg(F.min("second").alias("s"), F.max("confidence").alias("c"), F.count("*").alias("n"), (F.max("second") - F.min("second")).alias("d"))
    return t.select("recording", "taxon", g.caption(F.col("taxon"), F.col("recording"), F.col("s"), F.col("c"), F.col("n"), F.lit(1.0)).alias("caption"), g.held(F.col("d")).alias("held"))


_RGB = "rgb AS (SELECT name, dim_t, greatest(0, least(255, floor(255*r/f + 0.5))) AS r, greatest(0, least(255, floor(255*g/f + 0.5))) AS g, greatest(0, least(255, floor(255*b/f + 0.5))) AS b FROM (SELECT name, dim_t, r, g, b, CASE WHEN greatest(r,g,b) <= 1.001::DOUBLE THEN 1.0::DOUBLE WHEN greatest(r,g,b) <= 255 THEN 255 WHEN greatest(r,g,b) <= 1023 THEN 1023 ELSE 65535 END AS f FROM (SELECT name, dim_t, frame_difference AS r, std_intensity AS g, depth_m AS b FROM slices)))"
_LIM = "lim AS (SELECT name AS k, list_sort(list(l))[CAST(least(count(*)-1, floor(0.02::DOUBLE*count(*))) AS INT)+1] AS lo, list_sort(list(l))[CAST(least(count(*)-1, floor(0.98::DOUBLE*count(*))) AS INT)+1] AS hi FROM (SELECT name, 0.299::DOUBLE*r + 0.587::DOUBLE*g + 0.114::DOUBLE*b AS l FROM rgb) GROUP BY 1)"


@query(with_sql(SLICES, _RGB, _LIM) + """SELECT name, dim_t, greatest(0, least(255, floor(40 + 200*lit + 3*(r-grey) + 0.5))) AS r, greatest(0, least(255, floor(40 + 200*lit + 3*(g-grey) + 0.5))) AS g, greatest(0, least(255, floor(40 + 200*lit + 3*(b-grey) + 0.5))) AS b
FROM (SELECT *, (r+g+b)/3 AS grey, greatest(0, least(1, ((r+g+b)/3 - lo) / CASE WHEN hi - lo <> 0 THEN hi - lo ELSE 1 END)) AS lit FROM rgb JOIN lim ON k = name)""")
def strip_colours(spark, sf_dir):
    s = adapt.slices(spark, sf_dir).select("name", "dim_t", g.scaled(F.col("frame_difference"), F.col("std_intensity"), F.col("depth_m")).alias("rgb"))
    x = g.stretched(s, "name")
    return x.select("name", "dim_t", *[F.get("shown", i).alias(c) for i, c in enumerate("rgb")])


@query(with_sql(SLICES, TAXONOMY) + """SELECT path, branch FROM (SELECT DISTINCT array_to_string(lineage[1:d], '>') AS path, CASE WHEN len(lineage) > 2 THEN CASE WHEN d >= 2 THEN lineage[2] END ELSE lineage[1] END AS branch
  FROM (SELECT lineage, unnest(range(1, len(lineage)+1)) AS d FROM (SELECT DISTINCT CASE WHEN t.name IS NOT NULL THEN [kingdom, phylum, class, detection_top_class] ELSE ['Unplaced', detection_top_class] END AS lineage FROM slices s LEFT JOIN taxonomy t ON t.name = detection_top_class WHERE detection_top_class IS NOT NULL)))""")
def sunburst_branches(spark, sf_dir):
    """Every node with the phylum it sits in; none above the phylum."""
    from .trees import _counts

    x = _counts(spark, sf_dir).select("lineage", F.explode(F.sequence(F.lit(1), F.size("lineage"))).alias("d"))
    branch = F.when(F.size("lineage") > 2, F.when(F.col("d") >= 2, F.get("lineage", 1))).otherwise(F.get("lineage", 0))
    return x.select(F.array_join(F.slice("lineage", F.lit(1), F.col("d")), ">").alias("path"), branch.alias("branch")).distinct()


@query(with_sql(SIGHTINGS) + "SELECT recording, second, CAST(count(DISTINCT concat_ws(',', CAST(x1 AS VARCHAR), CAST(y1 AS VARCHAR), CAST(x2 AS VARCHAR), CAST(y2 AS VARCHAR))) AS BIGINT) AS boxes, CAST(count(DISTINCT taxon) AS BIGINT) AS species FROM sightings GROUP BY 1, 2")
def animals_at_moment(spark, sf_dir):
    return adapt.sightings(spark, sf_dir).groupBy("recording", "second").agg(F.count_distinct(F.struct(*link.BOX)).alias("boxes"), F.count_distinct("taxon").alias("species"))


@query(with_sql(SIGHTINGS) + f"SELECT taxon, count(*) AS sightings FROM sightings WHERE lower(trim(taxon)) NOT IN ({', '.join(repr(x) for x in link.NOT_ANIMAL)}) AND (confidence >= 0.25 OR x1 % 9 = 0 OR x1 % 10 = 0) GROUP BY 1")
def animals_above_floor(spark, sf_dir):
    """Sightings over a floor; those without a confidence pass."""
    c = F.when(F.col("x1") % 9 == 0, None).when(F.col("x1") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("confidence"))
    s = adapt.sightings(spark, sf_dir).withColumn("confidence", c)
    return s.where(link.is_animal(F.col("taxon")) & choices.above(F.col("confidence"), 0.25)).groupBy("taxon").agg(F.count("*").alias("sightings"))


def _greedy(same: str) -> str:
    """`leaders`: the rows of each moment, surest first, that no earlier leader is the same as. same: SQL over k and o."""
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY recording, second ORDER BY confidence DESC, ord) AS r FROM sightings),
walk AS (SELECT recording, second, 0::BIGINT AS r, []::STRUCT(ord VARCHAR, r BIGINT, x1 INT, y1 INT, x2 INT, y2 INT)[] AS kept FROM (SELECT DISTINCT recording, second FROM sightings)
  UNION ALL SELECT w.recording, w.second, o.r, CASE WHEN len(list_filter(w.kept, lambda k: {same})) = 0 THEN list_append(w.kept, struct_pack(ord := o.ord, r := o.r, x1 := o.x1, y1 := o.y1, x2 := o.x2, y2 := o.y2)) ELSE w.kept END FROM walk w JOIN ranked o ON o.recording = w.recording AND o.second = w.second AND o.r = w.r + 1),
leaders AS (SELECT recording, second, unnest(arg_max(kept, r)) AS k FROM walk GROUP BY recording, second)"""


_BOTH = "(greatest(0, least(k.x2, o.x2) - greatest(k.x1, o.x1)) * greatest(0, least(k.y2, o.y2) - greatest(k.y1, o.y1)))"
_SIZE = "(({t}.x2 - {t}.x1) * ({t}.y2 - {t}.y1))"
_OVER = f"{_BOTH}::DOUBLE / ({_SIZE.format(t='k')} + {_SIZE.format(t='o')} - {_BOTH})"
_FUSED = f"({_OVER} >= 0.45::DOUBLE OR {_BOTH}::DOUBLE / least({_SIZE.format(t='k')}, {_SIZE.format(t='o')}) >= 0.7::DOUBLE)"


@query(rec_sql(SIGHTINGS, _greedy(_FUSED)) + f"""SELECT recording, second, label, count(*) AS votes, round(sum(c) / 3, 5) AS confidence, x1, y1, x2, y2
FROM (SELECT recording, second, first, pass, max(confidence) AS c, any_value(label) AS label, any_value(x1) AS x1, any_value(y1) AS y1, any_value(x2) AS x2, any_value(y2) AS y2
  FROM (SELECT o.recording, o.second, o.x1 % 3 AS pass, o.confidence, arg_min(l.k.ord, l.k.r) AS first, arg_min(t.taxon, l.k.r) AS label, arg_min(l.k.x1, l.k.r)::DOUBLE AS x1, arg_min(l.k.y1, l.k.r)::DOUBLE AS y1, arg_min(l.k.x2, l.k.r)::DOUBLE AS x2, arg_min(l.k.y2, l.k.r)::DOUBLE AS y2
    FROM ranked o JOIN (SELECT recording, second, k FROM leaders) l ON l.recording = o.recording AND l.second = o.second AND l.k.r <= o.r JOIN ranked t ON t.recording = l.recording AND t.second = l.second AND t.r = l.k.r
    WHERE l.k.r = o.r OR {_FUSED.replace("k.", "l.k.")} GROUP BY o.recording, o.second, o.r, o.x1, o.confidence) GROUP BY recording, second, first, pass) GROUP BY recording, second, first, label, x1, y1, x2, y2""")
def fused_passes(spark, sf_dir):
    """Boxes of one moment as three passes over one frame."""
    s = adapt.sightings(spark, sf_dir).withColumn("pass_no", F.pmod(F.col("x1"), F.lit(3)))
    return link.fuse_passes(s, 3, ["recording", "second"])


@query(rec_sql(SIGHTINGS, _greedy(f"{_OVER} >= 0.3::DOUBLE")) + "SELECT recording, second, k.ord AS ord FROM leaders")
def distinct_individuals(spark, sf_dir):
    return link.distinct_individuals(adapt.sightings(spark, sf_dir), ["recording", "second"]).select("recording", "second", "ord")


_SECONDS = ", ".join(f"count(*) FILTER (WHERE verdict='{v}')::DOUBLE AS verdict_seconds_{v}" for v in triage.VERDICTS)


@query(with_sql(*_J) + f"""SELECT s.name, s.dim_t, 1 AS obs_level, verdict AS slice_verdict, NULL::DOUBLE AS footage_seconds, {", ".join(f"NULL::DOUBLE AS verdict_seconds_{v}" for v in triage.VERDICTS)} FROM slices s LEFT JOIN judged j ON j.name = s.name AND j.t = s.dim_t
UNION ALL SELECT name, NULL, 0, NULL, count(*)::DOUBLE, {_SECONDS} FROM judged GROUP BY name""")
def judged_report(spark, sf_dir):
    """Slices and recording rows with the verdict columns written back."""
    s = adapt.slices(spark, sf_dir)
    rec = s.groupBy("name").agg(F.first("expedition").alias("expedition")).select("name", "expedition", F.lit(0).alias("obs_level"))
    report = s.unionByName(rec, allowMissingColumns=True)
    return triage.describe(report, triage.verdicts(triage.timeline(s))).select("name", "dim_t", "obs_level", "slice_verdict", "footage_seconds", *[f"verdict_seconds_{v}" for v in triage.VERDICTS])
