"""Queries over text, formats, JSON and numeric planes."""

from __future__ import annotations

from pyspark.sql import functions as F

from benthos import schema
from benthos.functions import exprs as x
from benthos.operators import triage
from benthos.sources import listings

from . import adapt
from .adapt import SIGHTINGS, SLICES, read, with_sql
from .registry import query

_CLEAN = "regexp_replace(url, '[?#].*$', '')"


@query(f"""SELECT page_id, regexp_extract({_CLEAN}, '([^/]*)/?$', 1) AS file, regexp_replace(regexp_extract({_CLEAN}, '([^/]*)/?$', 1), '\\.[^.]*$', '') AS stem,
  coalesce(nullif(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), ''), 'unnamed') AS slug FROM pages""")
def page_names(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", x.file_name(u).alias("file"), x.stem(u).alias("stem"), x.slug(u).alias("slug"))


@query("SELECT page_id, CAST(pos AS BIGINT) AS pos, href FROM (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS h FROM pages))")
def page_links(spark, sf_dir):
    return listings.links(read(spark, sf_dir, "pages"), "page_id", "html").select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(r"""SELECT p_partkey, name, CASE WHEN note <> '' THEN note END AS note, CASE WHEN contains(note, '-') THEN trim(split_part(note, '-', 1)) END AS half, nullif(regexp_extract(note, '^\s*(\S+)', 1), '') AS first
FROM (SELECT p_partkey, name, CASE WHEN p_partkey % 3 = 0 THEN left(name, length(name) - 8) WHEN p_partkey % 3 = 1 THEN left(name, length(name) - 4) ELSE name END AS note FROM (SELECT p_partkey, concat(p_name, '-', p_type, CASE WHEN p_partkey % 3 = 0 THEN ' complex' WHEN p_partkey % 3 = 1 THEN ' spp' ELSE '' END) AS name FROM part))""")
def name_candidates(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("-"), "p_type", F.when(F.col("p_partkey") % 3 == 0, " complex").when(F.col("p_partkey") % 3 == 1, " spp").otherwise("")).alias("name"))
    note = F.left("name", F.length("name") - F.when(F.col("p_partkey") % 3 == 0, 8).when(F.col("p_partkey") % 3 == 1, 4).otherwise(0))
    p = p.withColumn("c", x.candidates(F.col("name"))).withColumn("note", note)
    has = lambda v: F.when(F.array_contains("c", v), v)  # noqa: E731  every part must be among the candidates
    return p.select("p_partkey", "name", has(F.col("note")).alias("note"), has(F.trim(F.split("note", "-")[0])).alias("half"), has(F.regexp_extract("note", r"^\s*(\S+)", 1)).alias("first"))


@query("""SELECT o_orderkey, name, try_strptime(nullif(regexp_extract(name, '_([0-9]{8}T[0-9]{6})', 1), ''), '%Y%m%dT%H%M%S') AS at, CAST(regexp_extract(name, '(?i)dive([0-9]+)', 1) AS INT) AS dive
FROM (SELECT o_orderkey, concat('EX_Dive0', CAST(o_custkey % 90 AS VARCHAR), '_', strftime(o_orderdate, '%Y%m%d'), 'T', CASE WHEN o_orderkey % 9 = 0 THEN '250000' ELSE '123456' END, 'Z.mp4') AS name FROM orders)""")
def name_stamps(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("EX_Dive0"), (F.col("o_custkey") % 90).cast("string"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("T"), F.when(F.col("o_orderkey") % 9 == 0, "250000").otherwise("123456"), F.lit("Z.mp4")).alias("name"))
    return o.select("o_orderkey", "name", x.recorded_at(F.col("name")).alias("at"), x.dive_number(F.col("name")).alias("dive"))


@query("""SELECT o_orderkey, CASE WHEN length(n) > 34 THEN concat(d, ' ', rtrim(substring(n, 1, 33)), '…') ELSE concat(d, ' ', n) END AS label FROM (SELECT o_orderkey, d, left(split_part(t, ':', 1), length(split_part(t, ':', 1)) - CASE WHEN o_custkey % 2 = 0 THEN 12 ELSE 6 END) AS n
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS d, concat(o_orderpriority, ' of a long expedition ', CAST(o_custkey AS VARCHAR), CASE WHEN o_custkey % 2 = 0 THEN ' 1990 - ' ELSE ', ' END, strftime(o_orderdate, '%Y'), ': more') AS t, o_custkey FROM orders))""")
def expedition_labels(spark, sf_dir):
    t = F.concat("o_orderpriority", F.lit(" of a long expedition "), F.col("o_custkey").cast("string"), F.when(F.col("o_custkey") % 2 == 0, " 1990 - ").otherwise(", "), F.date_format("o_orderdate", "yyyy"), F.lit(": more"))
    return read(spark, sf_dir, "orders").select("o_orderkey", x.expedition_label(t, F.date_format("o_orderdate", "yyyy-MM")).alias("label"))


@query("SELECT n_name, CAST(list_reduce(list_prepend(0::BIGINT, list_transform(string_split(n_name, ''), lambda c: unicode(c)::BIGINT)), lambda h, c: (h * 31 + c) % 2147483647) AS BIGINT) AS hash FROM nation")
def name_hashes(spark, sf_dir):
    return read(spark, sf_dir, "nation").select("n_name", x.name_hash(F.col("n_name")).alias("hash"))


_TWO = "lpad(CAST({v} AS VARCHAR), 2, '0')"


@query(with_sql(SLICES) + f"SELECT name, dim_t, concat({_TWO.format(v='s // 3600')}, ':', {_TWO.format(v='(s // 60) % 60')}, ':', {_TWO.format(v='s % 60')}) AS clock, concat(printf('%.3f', abs(lat)), '°', CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END) AS latitude FROM (SELECT name, dim_t, CAST(floor(dim_t * 7 / fps + 0.5) AS BIGINT) AS s, (depth_m - 2000) / 50 AS lat FROM slices)")
def clocks_and_degrees(spark, sf_dir):
    s = adapt.slices(spark, sf_dir)
    return s.select("name", "dim_t", x.clock(F.col("dim_t") * 7 / F.col("fps")).alias("clock"), x.degrees((F.col("depth_m") - 2000) / 50, "NS").alias("latitude"))


@query(with_sql(SIGHTINGS) + "SELECT concat_ws(',', recording, printf('%.2f', second), concat(lpad(CAST(CAST(round(second*100) AS BIGINT) // 6000 AS VARCHAR), 2, '0'), ':', lpad(CAST((CAST(round(second*100) AS BIGINT) // 100) % 60 AS VARCHAR), 2, '0'), '.', lpad(CAST(CAST(round(second*100) AS BIGINT) % 100 AS VARCHAR), 2, '0')), taxon, printf('%.3f', confidence), CAST(x1 AS VARCHAR), CAST(y1 AS VARCHAR), CAST(x2 AS VARCHAR), CAST(y2 AS VARCHAR)) AS line FROM sightings")
def sightings_csv(spark, sf_dir):
    s = F.col("second")
    return adapt.sightings(spark, sf_dir).select(F.concat_ws(",", "recording", F.format_string("%.2f", s), x.timecode(s), "taxon", F.format_string("%.3f", "confidence"), *[F.col(c).cast("string") for c in ("x1", "y1", "x2", "y2")]).alias("line"))


_DET = """dets AS (SELECT name, dim_t, concat('[', CASE WHEN detection_count > 0 THEN concat('{"class":"', detection_top_class, '","conf":', CAST(detection_confidence AS VARCHAR), ',"box":[1,2,', CAST(dim_t % 600 AS VARCHAR), ',40]}') ELSE '' END,
  CASE WHEN detection_count > 1 THEN ',{"class":"x","of":0,"clip":1,"box":[0,0,5,5]}' ELSE '' END, CASE WHEN detection_count > 2 THEN ',{"class":"y","of":0,"clip":true,"box":[0,0,6,6]}' ELSE '' END, ']') AS detections FROM slices)"""


def _dets(spark, sf_dir):
    c = F.col
    one = F.format_string('{"class":"%s","conf":%s,"box":[1,2,%s,40]}', "detection_top_class", c("detection_confidence").cast("string"), (c("dim_t") % 600).cast("string"))
    text = F.concat(F.lit("["), F.when(c("detection_count") > 0, one).otherwise(""), F.when(c("detection_count") > 1, F.lit(',{"class":"x","of":0,"clip":1,"box":[0,0,5,5]}')).otherwise(""), F.when(c("detection_count") > 2, F.lit(',{"class":"y","of":0,"clip":true,"box":[0,0,6,6]}')).otherwise(""), F.lit("]"))
    return adapt.slices(spark, sf_dir).select("name", "dim_t", text.alias("detections"))


@query(with_sql(SLICES, _DET) + "SELECT name, dim_t, json_extract_string(d, '$.class') AS taxon, CAST(json_extract(d, '$.conf') AS DOUBLE) AS conf, CAST(json_extract(d, '$.box[2]') AS INT) AS x2 FROM (SELECT name, dim_t, unnest(CAST(detections AS JSON[])) AS d FROM dets) WHERE json_extract(d, '$.clip') IS NULL")
def detections_flat(spark, sf_dir):
    """Detections without clip frames, one row each."""
    d = _dets(spark, sf_dir).select("name", "dim_t", F.explode(schema.without_clips(schema.detections(F.col("detections")))).alias("d"))
    return d.select("name", "dim_t", F.col("d.class").alias("taxon"), F.col("d.conf").alias("conf"), F.get("d.box", 2).alias("x2"))


@query(with_sql(SLICES, _DET) + "SELECT name, dim_t, CAST(len(CAST(detections AS JSON[])) AS BIGINT) AS entries, CAST(len(list_filter(CAST(detections AS JSON[]), lambda d: json_extract(d, '$.clip') IS NOT NULL)) AS BIGINT) AS clips FROM dets")
def detection_counts(spark, sf_dir):
    e = schema.detections(F.col("detections"))
    return _dets(spark, sf_dir).select("name", "dim_t", F.size(e).cast("bigint").alias("entries"), F.size(F.filter(e, schema.is_clip)).cast("bigint").alias("clips"))


@query(with_sql(SLICES) + "SELECT name, dim_t, CASE WHEN depth_m >= 2000 THEN 'deep' ELSE 'shallow' END AS band, detection_count FROM slices WHERE detection_count > 0")
def finite_timeline(spark, sf_dir):
    s = adapt.slices(spark, sf_dir)
    t = triage.timeline(s).join(s.select("name", F.col("dim_t").alias("t"), "depth_m"), ["name", "t"]).where("detections > 0")
    return t.select("name", F.col("t").alias("dim_t"), F.when(F.col("depth_m") >= 2000, "deep").otherwise("shallow").alias("band"), F.col("detections").alias("detection_count"))
