"""Queries over small semi-structured inputs and what is written from them, made from the driver's tables as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from benthos.functions import exprs as x
from benthos.operators import gallery, hierarchy, reports
from benthos.sources import collection, listings, sinks

from . import adapt
from .adapt import SIGHTINGS, SLICES, read, with_sql
from .registry import query
from .timelines import _E, SCORED, _events, rec_sql

_TEXT = lambda c: F.col(c).cast("string")


@query("SELECT CAST(l_orderkey % 1000 AS INT) AS frame, CAST(l_partkey AS BIGINT) AS track, count(*) AS boxes, CAST(sum(l_suppkey + l_quantity) AS DOUBLE) AS x2 FROM lineitem WHERE l_linenumber % 4 <> 0 GROUP BY 1, 2")
def truth_lines(spark, sf_dir):
    """Annotation lines with some that can't be read."""
    k = F.when(F.col("l_linenumber") % 4 == 0, "bad").otherwise(_TEXT("l_suppkey"))
    lines = read(spark, sf_dir, "lineitem").select(F.concat_ws(",", (F.col("l_orderkey") % 1000).cast("string"), _TEXT("l_partkey"), k, F.lit("7"), _TEXT("l_quantity"), F.lit("9"), F.lit("1")).alias("value"))
    return listings.truth(lines).groupBy("frame", "track").agg(F.count("*").alias("boxes"), F.sum("x2").alias("x2"))


@query("SELECT s_suppkey::DOUBLE AS unixtime, s_acctbal::DOUBLE AS latitude, s_nationkey::DOUBLE AS longitude, CASE WHEN s_suppkey % 3 <> 0 THEN abs(s_acctbal)::DOUBLE END AS depth_m FROM supplier WHERE s_suppkey % 5 <> 0")
def navigation_fixes(spark, sf_dir):
    """A track whose headers and gaps are as archives write them."""
    s = read(spark, sf_dir, "supplier")
    t = s.select(_TEXT("s_suppkey").alias("Unix Time"), _TEXT("s_suppkey").alias("UnixTime (s)"), F.when(F.col("s_suppkey") % 5 != 0, _TEXT("s_acctbal")).otherwise("").alias("Lat (dec. deg.)"), _TEXT("s_nationkey").alias(" Longitude"), F.when(F.col("s_suppkey") % 3 != 0, _TEXT("s_acctbal")).otherwise("NaN").alias("Depth (m)")).drop("Unix Time")
    return listings.navigation(t).select("unixtime", "latitude", "longitude", "depth_m")


@query("""SELECT s_suppkey, CAST(s_suppkey AS DOUBLE) + 0.5 AS max_depth_m, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS DOUBLE) / 4 END AS seafloor_depth_m, concat('2020-01-01T', lpad(CAST(s_suppkey % 24 AS VARCHAR), 2, '0'), ':00:00') AS on_bottom_at,
  round(CASE s_suppkey % 3 WHEN 0 THEN s_nationkey + 0.25::DOUBLE WHEN 1 THEN -(s_nationkey + 30 / 60.0::DOUBLE) END, 6) AS latitude, round(CASE s_suppkey % 3 WHEN 0 THEN -79.5 WHEN 1 THEN 12 + 6 / 60.0::DOUBLE END, 6) AS longitude FROM supplier""")
def dive_reports(spark, sf_dir):
    """Dive reports in both generations of the format; some positions are not known."""
    s = read(spark, sf_dir, "supplier")
    k, n = _TEXT("s_suppkey"), _TEXT("s_nationkey")
    where = F.when(F.col("s_suppkey") % 3 == 0, F.concat(n, F.lit(".25 ; -79.5"))).when(F.col("s_suppkey") % 3 == 1, F.concat(n, F.lit("°, 30.0' S ; 12°, 6' E"))).otherwise("N/A ; N/A")
    deep = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Max Vehicle Depth: "), k, F.lit(".5 m\r\nMin Seafloor Depth: "), (F.col("s_suppkey") / 4).cast("string"))).otherwise(F.concat(F.lit("Max. depth: "), k, F.lit(".5 m")))
    text = F.concat(F.lit("DIVE REPORT\n"), deep, F.lit("\nOn Bottom: 2020-01-01T"), F.lpad((F.col("s_suppkey") % 24).cast("string"), 2, "0"), F.lit(":00:00 \r\n  "), where, F.lit("\nOff Bottom:\n"))
    d = listings.dive_summary(s.select("s_suppkey", text.alias("text")))
    return d.select("s_suppkey", "max_depth_m", "seafloor_depth_m", "on_bottom_at", F.round("on_bottom_position.latitude", 6).alias("latitude"), F.round("on_bottom_position.longitude", 6).alias("longitude"))


@query("SELECT s_nationkey, count(*) AS points, round(sum(s_acctbal), 2) AS longitudes, CAST(min(s_suppkey) AS DOUBLE) AS south FROM supplier WHERE s_suppkey % 7 <> 0 GROUP BY 1")
def kml_paths(spark, sf_dir):
    """Coordinates of each path, some unreadable."""
    s = read(spark, sf_dir, "supplier")
    one = F.concat_ws(",", F.when(F.col("s_suppkey") % 7 != 0, _TEXT("s_acctbal")).otherwise("x"), _TEXT("s_suppkey"), F.lit("0"))
    docs = s.groupBy("s_nationkey").agg(F.concat(F.lit("<kml><coordinates>\n "), F.concat_ws("\n ", F.collect_list(one)), F.lit("</coordinates></kml>")).alias("text"))
    p = docs.select("s_nationkey", F.explode(listings.coordinates(F.col("text"))).alias("p"))
    return p.groupBy("s_nationkey").agg(F.count("*").alias("points"), F.round(F.sum("p.longitude"), 2).alias("longitudes"), F.min("p.latitude").alias("south"))


@query("""WITH reg AS (SELECT CAST(s_suppkey AS INT) AS no, s_nationkey AS ref, TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey * 37 % 2000 AS INT)) AS start, CASE WHEN s_suppkey % 4 <> 0 THEN TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey * 37 % 2000 + 300 AS INT)) END AS stop, s_acctbal AS depth FROM supplier WHERE s_suppkey % 6 <> 0)
SELECT o_orderkey, no, depth AS depth_m FROM (SELECT o_orderkey, no, depth, row_number() OVER (PARTITION BY o_orderkey ORDER BY no) AS r FROM orders LEFT JOIN reg ON ref = o_custkey % 25 AND o_orderdate >= start AND (stop IS NULL OR o_orderdate <= stop)) WHERE r = 1""")
def deployed_recordings(spark, sf_dir):
    """Recordings of fixed cameras with the deployment that covers their date; rows of the register without a place don't count."""
    k = F.col("s_suppkey")
    day = lambda n: F.date_format(F.date_add(F.lit("1992-01-01"), n.cast("int")), "yyyy-MM-dd'T'HH:mm:ss")
    reg = read(spark, sf_dir, "supplier").select(_TEXT("s_nationkey").alias("Reference Designator"), k.cast("string").alias("deploymentNumber"), day(k * 37 % 2000).alias("startDateTime"), F.when(k % 4 != 0, day(k * 37 % 2000 + 300)).otherwise(" ").alias("stopDateTime"), F.when(k % 6 != 0, "44.5").otherwise("n/a").alias("lat"), F.lit("-125").alias("lon"), _TEXT("s_acctbal").alias("deployment_depth"))
    rec = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), (F.col("o_custkey") % 25).cast("string").alias("ref"), F.col("o_orderdate").cast("timestamp_ntz").alias("recorded_at"))
    return collection.deployed(rec, reg).select(F.col("name").alias("o_orderkey"), "no", "depth_m")


_CLOCK = "concat(lpad(CAST(w // 3600 AS VARCHAR), 2, '0'), ':', lpad(CAST((w // 60) % 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(w % 60 AS VARCHAR), 2, '0'))"


@query(rec_sql(*_E, SCORED) + f"SELECT concat_ws(',', name, printf('%.2f', from_t / 30.0::DOUBLE), printf('%.2f', to_t / 30.0::DOUBLE), {_CLOCK}, kind, coalesce(top_class, '')) AS line, CASE WHEN confidence IS NOT NULL THEN printf('%.2f', confidence) ELSE '' END AS certainty FROM (SELECT *, CAST(floor(from_t / 30.0::DOUBLE + 0.5) AS BIGINT) AS w FROM scored)")
def events_list(spark, sf_dir):
    """The event list for annotation tools."""
    from benthos.operators import triage

    j, e = _events(spark, sf_dir)
    t = sinks.events_csv(triage.interest(e, j), F.lit(30.0))
    return t.select(F.concat_ws(",", "recording", "start_seconds", "end_seconds", "start_timecode", "kind", "taxon").alias("line"), F.col("certainty_0_to_1").alias("certainty"))


@query("SELECT concat_ws(',', n_name, c_name, printf('%.2f', c_custkey / 3.0::DOUBLE), c_mktsegment, '', CASE WHEN n_nationkey % 3 <> 0 THEN r_name ELSE '' END, CASE WHEN n_nationkey % 3 <> 0 THEN 'CC' ELSE '' END) AS line FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def favourites_list(spark, sf_dir):
    """Kept animals with the terms of their archive, nothing where it has none."""
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    f = read(spark, sf_dir, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_nationkey").alias("archive"), F.col("n_name").alias("expedition"), F.col("c_name").alias("recording"), (F.col("c_custkey") / 3.0).alias("second"), F.col("c_mktsegment").alias("taxon"), F.lit(None).cast("string").alias("guess"))
    terms = n.where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("archive"), F.col("r_name").alias("credit"), F.lit("CC").alias("licence"))
    t = sinks.favourites_csv(f, terms)
    return t.select(F.concat_ws(",", *t.columns).alias("line"))


@query(rec_sql(*_E) + "SELECT e.name, e.kind, coalesce(e.label, '') AS label, e.s, e.from_t AS t, CASE WHEN l.detection_count > 0 THEN concat('crop', CAST(l.dim_t AS VARCHAR)) ELSE concat('still', CAST(l.dim_t AS VARCHAR)) END AS picture FROM events_ e LEFT JOIN slices l ON l.name = e.name AND l.dim_t = e.from_t")
def event_stills(spark, sf_dir):
    """The picture of each event's first slice: its crop, else its thumbnail."""
    t = _TEXT("dim_t")
    s = adapt.slices(spark, sf_dir).select("name", "dim_t", F.when(F.col("detection_count") > 0, F.concat(F.lit("crop"), t)).alias("detection_crop"), F.concat(F.lit("still"), t).alias("slice_thumbnail"))
    e = _events(spark, sf_dir)[1].select("name", "kind", F.coalesce("label", F.lit("")).alias("label"), F.col("s").cast("bigint").alias("s"), F.col("from_t").alias("t"))
    return gallery.stills(e, s)


@query("SELECT c_custkey AS k, concat('1995-02 ', n_name) AS expedition, c_acctbal::DOUBLE AS depth_m FROM customer JOIN nation ON n_nationkey = 3 WHERE c_nationkey = 3 UNION ALL SELECT s_suppkey, 'plain', NULL FROM supplier WHERE s_nationkey = 5")
def combined_report(spark, sf_dir):
    """Two expeditions in one table, without pictures, labelled for an axis."""
    a = read(spark, sf_dir, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("depth_m"), F.lit(b"x").alias("detection_crop"))
    b = read(spark, sf_dir, "supplier").where("s_nationkey = 5").select(F.col("s_suppkey").alias("k"), F.lit(b"y").alias("slice_thumbnail"))
    title = read(spark, sf_dir, "nation").where("n_nationkey = 3").select(F.lit("EX3").alias("id"), F.concat("n_name", F.lit(", 1995: notes")).alias("title"), F.lit("1995-02").alias("date"))
    return reports.combine({"EX3": a, "plain": b}, title).select("k", "expedition", "depth_m")


@query(with_sql(SIGHTINGS) + "SELECT ord, CASE WHEN count(*) OVER (PARTITION BY recording) = count(stored) OVER (PARTITION BY recording) THEN stored END AS animal FROM (SELECT *, CASE WHEN recording <> 'rec_7' OR x1 % 5 <> 0 THEN x1 % 9 END AS stored FROM sightings)")
def rebuilt_ids(spark, sf_dir):
    """Stored individuals, of the recordings in which every sighting has one."""
    s = adapt.sightings(spark, sf_dir).withColumn("stored", F.when((F.col("recording") != "rec_7") | (F.col("x1") % 5 != 0), F.col("x1") % 9))
    return reports.rebuilt(s).select("ord", "animal")


@query(with_sql(SIGHTINGS) + "SELECT recording AS name, CAST(second * 4 AS BIGINT) AS dim_t, concat(lpad(CAST(CAST(round(second*100) AS BIGINT) // 6000 AS VARCHAR), 2, '0'), ':', lpad(CAST((CAST(round(second*100) AS BIGINT) // 100) % 60 AS VARCHAR), 2, '0'), '.', lpad(CAST(CAST(round(second*100) AS BIGINT) % 100 AS VARCHAR), 2, '0')) AS timecode, taxon, confidence, x1, y2, concat(CASE WHEN x1 % 2 = 0 THEN 'UklGR' ELSE '/9j/' END, ord) AS crop, CASE WHEN x1 % 2 = 0 THEN 'image/webp' ELSE 'image/jpeg' END AS kind FROM sightings")
def keyed_sightings(spark, sf_dir):
    """Sightings under the report's own keys, with the type of their picture."""
    s = adapt.sightings(spark, sf_dir)
    s = s.withColumn("slice_t", (F.col("second") * 4).cast("bigint")).withColumn("frame", F.lit(0)).withColumn("crop", F.concat(F.when(F.col("x1") % 2 == 0, "UklGR").otherwise("/9j/"), "ord"))
    return sinks.keyed_sightings(s).select("name", "dim_t", "timecode", "taxon", "confidence", "x1", "y2", "crop", x.picture_type(F.col("crop")).alias("kind"))


@query(with_sql(SIGHTINGS) + "SELECT recording, taxon AS animal, count(*) AS looks, round(min(round_even(second, 1)), 1) AS first, md5(CAST(string_agg(CAST(x1 AS VARCHAR), ',' ORDER BY second, ord) AS VARCHAR)) AS boxes FROM sightings GROUP BY 1, 2")
def reel_looks(spark, sf_dir):
    """Every look of each individual, in order."""
    l = gallery.looks(adapt.sightings(spark, sf_dir).withColumn("animal", F.col("taxon")))
    box = F.array_join(F.transform("looks", lambda v: v[1].cast("int").cast("string")), ",")
    return l.select("recording", "animal", F.size("looks").cast("bigint").alias("looks"), F.get(F.get("looks", 0), 0).alias("first"), F.md5(box.cast("binary")).alias("boxes"))


@query("SELECT s_suppkey, concat('[', '{\"e\":', CAST(s_nationkey AS VARCHAR), ',\"r\":\"', s_name, '\"}', ']') AS rows FROM supplier")
def shared_links(spark, sf_dir):
    """Lists of kept animals, deflated into a link and read back."""
    s = read(spark, sf_dir, "supplier").withColumn("kept", F.array(F.struct(F.col("s_nationkey").cast("int").alias("e"), F.col("s_name").alias("r"))))
    link = s.select("s_suppkey", gallery.share_link(F.col("kept"), deflate=True).alias("link"))
    return link.select("s_suppkey", F.to_json(gallery.unshared(F.col("link"), "array<struct<e:int,r:string>>")).alias("rows"))


@query("SELECT o_orderkey, epoch(o_orderdate) + CASE WHEN o_orderkey % 2 = 0 THEN -7200 ELSE 0 END AS at FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders)")
def instants(spark, sf_dir):
    """ISO moments with and without a zone."""
    t = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("o_orderkey") % 2 == 0, "+02:00").otherwise(""))
    return read(spark, sf_dir, "orders").select("o_orderkey", x.instant(t).alias("at"))


@query("SELECT r_name AS path, list(n_name ORDER BY n DESC, n_name) AS names FROM (SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2) GROUP BY 1")
def tree_children(spark, sf_dir):
    """What is under each node, most counted first."""
    n = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(read(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    nodes = hierarchy.tree(n.select(F.array("r_name", "n_name").alias("lineage"), F.lit(1).alias("n")))
    return hierarchy.children(nodes).where("path <> ''")


@query(with_sql(SLICES) + "SELECT expedition AS path, CAST(sum(detection_count) AS BIGINT) AS count FROM slices GROUP BY 1 HAVING sum(detection_count) > 0")
def expedition_counts(spark, sf_dir):
    """The tree's root level, by expedition."""
    n = adapt.slices(spark, sf_dir).where("detection_count > 0").select(F.array("expedition").alias("lineage"), F.col("detection_count").alias("n"))
    return hierarchy.tree(n).where("depth = 1").select("path", F.col("count").cast("bigint").alias("count"))
