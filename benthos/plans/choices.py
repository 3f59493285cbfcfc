"""Queries over roll-ups, moments, choices and totals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from benthos.functions import exprs as x
from benthos.operators import choices as c
from benthos.operators import gallery, hierarchy, joins, link, triage
from benthos.operators import rollups as r
from benthos.sources import sinks

from . import adapt
from .adapt import SIGHTINGS, SLICES, TAXONOMY, read, with_sql
from .registry import query
from .timelines import _E, SCORED, _events, rec_sql

# --- roll-ups ---------------------------------------------------------------------------------

_LEAF = """leaf AS (SELECT recording, second, ord, x1 % 4 AS dim_c, CASE WHEN x1 % 9 = 0 THEN NULL WHEN x1 % 11 = 0 THEN 'NaN'::DOUBLE ELSE x1 / 7.0::DOUBLE END AS v, CAST(y1 % 5 AS DOUBLE) AS w,
  CASE WHEN x1 % 7 <> 0 THEN confidence END AS conf, CASE WHEN y1 % 4 <> 0 THEN taxon ELSE '' END AS label, CASE WHEN y1 % 3 <> 0 THEN concat('crop', CAST(x1 AS VARCHAR)) END AS crop,
  CASE WHEN x1 % 5 <> 0 THEN concat('2020-01-', lpad(CAST(1 + y1 % 28 AS VARCHAR), 2, '0')) ELSE '' END AS stamp, CASE WHEN x1 % 2 = 0 THEN recording ELSE '' END AS outline, CASE WHEN y1 % 6 <> 0 THEN CAST(y2 AS DOUBLE) END AS tone FROM sightings)"""


@query(with_sql(SIGHTINGS, _LEAF) + """SELECT recording, second, round(sum(v * w) FILTER (WHERE v IS NOT NULL AND NOT isnan(v) AND w > 0) / nullif(sum(w) FILTER (WHERE v IS NOT NULL AND NOT isnan(v) AND w > 0), 0), 6) AS movement, max(v) FILTER (WHERE v IS NOT NULL AND NOT isnan(v)) AS peak, CAST(sum(w) AS BIGINT) AS pairs,
  arg_min(label, {'c': -coalesce(conf, 0), 'o': ord}) FILTER (WHERE label <> '') AS top_class, arg_min(crop, {'c': -coalesce(conf, 0), 'o': ord}) FILTER (WHERE crop IS NOT NULL) AS crop,
  min(nullif(stamp, '')) AS recorded_at, arg_min(outline, ord) FILTER (WHERE outline <> '') AS footprint,
  CASE WHEN count(tone) = 1 THEN max(tone) ELSE round(coalesce(arg_min(tone, ord) FILTER (WHERE tone IS NOT NULL AND dim_c = 1), avg(tone)), 6) END AS green FROM leaf GROUP BY recording, second""")
def rolled_leaves(spark, sf_dir):
    """Leaf rows of a slice as one row: weighted mean, peak, sum, surest payloads, earliest and shared values, a channel."""
    k = F.col
    s = adapt.sightings(spark, sf_dir)
    v = F.when(k("x1") % 9 == 0, None).when(k("x1") % 11 == 0, F.lit(float("nan"))).otherwise(k("x1") / F.lit(7.0))
    leaf = s.select("recording", "second", "ord", (k("x1") % 4).alias("dim_c"), v.alias("v"), (k("y1") % 5).cast("double").alias("w"), F.when(k("x1") % 7 != 0, k("confidence")).alias("conf"), F.when(k("y1") % 4 != 0, k("taxon")).otherwise("").alias("label"), F.when(k("y1") % 3 != 0, F.concat(F.lit("crop"), k("x1").cast("string"))).alias("crop"),
                    F.when(k("x1") % 5 != 0, F.concat(F.lit("2020-01-"), F.lpad((1 + k("y1") % 28).cast("string"), 2, "0"))).otherwise("").alias("stamp"), F.when(k("x1") % 2 == 0, k("recording")).otherwise("").alias("outline"), F.when(k("y1") % 6 != 0, k("y2").cast("double")).alias("tone"))
    return leaf.groupBy("recording", "second").agg(
        F.round(r.weighted_mean(k("v"), k("w")), 6).alias("movement"), r.nan_max(k("v")).alias("peak"), r.whole_sum(k("w")).alias("pairs"), r.of_surest(k("label"), k("conf"), k("ord")).alias("top_class"), r.of_surest(k("crop"), k("conf"), k("ord"), filled=False).alias("crop"),
        r.earliest(k("stamp")).alias("recorded_at"), r.shared(k("outline"), k("ord")).alias("footprint"), F.round(r.channel(k("tone"), k("dim_c"), k("ord"), 1), 6).alias("green"))


# --- moments and scores -----------------------------------------------------------------------


@query(with_sql(SLICES) + """, starts AS (SELECT name, min(epoch_us(recorded_at)) / 1000000.0::DOUBLE AS start FROM slices WHERE NOT ends_with(name, '4') GROUP BY 1), timed AS (SELECT s.name, dim_t, start + dim_t * 240 AS moment FROM slices s LEFT JOIN starts USING (name)),
fixes AS (SELECT concat('rec_', CAST(user_id AS VARCHAR)) AS name, epoch_us(ts) / 1000000.0::DOUBLE AS moment, value FROM events WHERE event_type = 'signup'),
b AS (SELECT l.name, l.dim_t, f.moment AS b_at, f.value AS b_v FROM timed l ASOF LEFT JOIN fixes f ON l.name = f.name AND l.moment >= f.moment), a AS (SELECT l.name, l.dim_t, f.moment AS a_at, f.value AS a_v FROM timed l ASOF LEFT JOIN fixes f ON l.name = f.name AND l.moment <= f.moment),
near AS (SELECT l.*, CASE WHEN a_at IS NULL OR abs(l.moment - b_at) <= abs(a_at - l.moment) THEN CASE WHEN abs(l.moment - b_at) <= 40000 THEN b_v END WHEN abs(a_at - l.moment) <= 40000 THEN a_v END AS value FROM timed l JOIN b USING (name, dim_t) JOIN a USING (name, dim_t))
SELECT name, dim_t, round(moment, 3) AS recorded_at, CASE WHEN moment IS NOT NULL THEN coalesce(value, CASE WHEN ends_with(name, '3') THEN -1 END) END AS value FROM near""")
def slice_places(spark, sf_dir):
    """Slices with their moment and the nearest fix; recordings that end in 4 have no start, those in 3 a fixed camera."""
    s = adapt.slices(spark, sf_dir)
    micros = lambda t: F.unix_micros(F.col(t).cast("timestamp")) / 1e6
    starts = s.where(~F.col("name").endswith("4")).groupBy("name").agg(F.min(micros("recorded_at")).alias("start"))
    fixes = read(spark, sf_dir, "events").where("event_type = 'signup'").select(F.concat(F.lit("rec_"), F.col("user_id").cast("string")).alias("name"), micros("ts").alias("at"), "value")
    fixed = s.where(F.col("name").endswith("3")).select("name", F.lit(-1.0).alias("value")).distinct()
    p = joins.placed_moments(s.select("name", "dim_t", F.lit(1 / 240).alias("fps")), starts, fixes, 40000.0, ["value"], fixed)
    return p.select("name", "dim_t", F.round("recorded_at", 3).alias("recorded_at"), "value")


@query(with_sql(SIGHTINGS) + """, annotated AS (SELECT DISTINCT recording, CAST(floor(second * 3) AS BIGINT) + 1 AS frame FROM sightings WHERE is_truth AND x1 % 3 = 0), three AS (SELECT recording, second, ord, CAST(round_even(second * 3, 0) AS BIGINT) + 1 + d AS frame FROM sightings, (VALUES (-1), (0), (1)) AS t(d) WHERE NOT is_truth),
near AS (SELECT t.ord, t.frame, abs((t.frame - 1) / 3.0::DOUBLE - second) AS off FROM three t JOIN annotated a ON a.recording = t.recording AND a.frame = t.frame)
SELECT ord, frame FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY off, frame) AS n FROM near) WHERE n = 1 AND off <= 0.5::DOUBLE / 3 * 3""")
def nearest_frames(spark, sf_dir):
    """Detections with the annotated frame nearest to their second, 1.5 frames off at most."""
    s = adapt.sightings(spark, sf_dir)
    annotated = s.where("is_truth and x1 % 3 = 0").select("recording", (F.floor(F.col("second") * 3) + 1).alias("frame"))
    return joins.nearest_frame(s.where("not is_truth").select("recording", "second", "ord"), annotated, ["recording"], F.lit(3.0)).select("ord", "frame")


_POOL = """judged AS (SELECT lang AS recording, CAST(n_chars % 1000 AS DOUBLE) / 1000 AS conf, lpad(CAST(d.doc_id AS VARCHAR), 12, '0') AS ord, CASE WHEN quality = 1 THEN d.doc_id % 50 END AS landed_on FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
curve AS (SELECT row_number() OVER w AS rank, count(landed_on) OVER w AS hits FROM judged WINDOW w AS (ORDER BY conf DESC, ord)), t AS (SELECT count(*) AS boxes FROM documents WHERE n_chars % 3 = 0), e AS (SELECT count(*) AS boxes, count(DISTINCT {'l': lang, 'd': doc_id % 50}) AS animals, count(*) FILTER (WHERE n_chars % 2 = 0) AS seen FROM documents),
j AS (SELECT count(*) AS n, count(landed_on) AS hits, count(DISTINCT {'l': recording, 'd': landed_on}) FILTER (WHERE landed_on IS NOT NULL) AS animals FROM judged)"""


@query(f"WITH {_POOL} SELECT j.n AS detections, j.hits AS matched, round(j.hits::DOUBLE / j.n, 6) AS precision, round(j.hits::DOUBLE / t.boxes, 6) AS recall, round(j.hits::DOUBLE / e.boxes, 6) AS recall_overall, round(j.animals::DOUBLE / e.animals, 6) AS recall_animals, round(e.seen::DOUBLE / e.boxes, 6) AS looked_at, round((SELECT max(hits) FROM curve WHERE hits::DOUBLE / rank >= 0.7) / t.boxes::DOUBLE, 6) AS at_floor, round((SELECT max(hits) FROM curve WHERE hits::DOUBLE / rank >= 0.7) / e.boxes::DOUBLE, 6) AS overall_at_floor FROM j, t, e")
def pooled_scores(spark, sf_dir):
    """All recordings as one curve; identities stay apart by recording."""
    d = read(spark, sf_dir, "documents")
    judged = d.join(read(spark, sf_dir, "labels"), "doc_id").select(F.col("lang").alias("recording"), ((F.col("n_chars") % 1000).cast("double") / 1000).alias("conf"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("ord"), F.when(F.col("quality") == 1, F.col("doc_id") % 50).alias("landed_on"))
    truth = d.where("n_chars % 3 = 0").groupBy(F.col("lang").alias("recording")).agg(F.count("*").alias("truth_boxes"))
    whole = d.groupBy(F.col("lang").alias("recording")).agg(F.count("*").alias("truth_boxes_all"), F.count_distinct(F.col("doc_id") % 50).alias("animals_all"), F.count("*").alias("frames_annotated"), F.count_if(F.col("n_chars") % 2 == 0).alias("frames_judged"))
    p = link.pooled(judged, truth, whole, 0.7)
    return p.select("detections", "matched", *[F.round(n, 6).alias(n) for n in p.columns[2:]])


# --- events -----------------------------------------------------------------------------------

_SORTED = {"interest": "score DESC", "time": "from_t", "duration": "slices DESC", "movement": "movement DESC", "particles": "objects DESC", "animals": "detections DESC", "confidence": "coalesce(confidence, 0) DESC"}
_VALUES = "SELECT name, kind, coalesce(label, '') AS label, s, slices, from_t, round(movement + 1e-9::DOUBLE, 6) AS movement, round(coalesce(detections, 0) + 1e-9::DOUBLE, 6) AS detections, confidence, round(score, 6) AS score, slices % 7 AS objects FROM scored"


@query(rec_sql(*_E, SCORED) + " UNION ALL ".join(f"SELECT '{k}' AS sort, name, kind, label, s, r FROM (SELECT *, row_number() OVER (ORDER BY {o}, name, s, kind, label) AS r FROM ({_VALUES})) WHERE r <= 12" for k, o in _SORTED.items()))
def events_by_sort(spark, sf_dir):
    """The first twelve events of each of the page's seven sorts."""
    j, e = _events(spark, sf_dir)
    v = triage.interest(e, j).select("name", "kind", F.coalesce("label", F.lit("")).alias("label"), F.col("s").cast("bigint").alias("s"), F.col("slices").cast("bigint").alias("slices"), "from_t", F.round(F.col("movement") + 1e-9, 6).alias("movement"), F.round(F.coalesce("detections", F.lit(0.0)) + 1e-9, 6).alias("detections"), "confidence", F.round("score", 6).alias("score"), (F.col("slices") % 7).alias("objects"))
    out = None
    for k in c.SORTS:
        top = v.orderBy(c.order_of(k), "name", "s", "kind", "label").limit(12)
        n = F.row_number().over(Window.orderBy(c.order_of(k), "name", "s", "kind", "label")).cast("bigint")  # twelve rows
        one = top.select(F.lit(k).alias("sort"), "name", "kind", "label", "s", n.alias("r"))
        out = one if out is None else out.unionAll(one)
    return out


@query(rec_sql(*_E) + "SELECT name, kind, coalesce(label, '') AS label, CAST(s AS BIGINT) AS s FROM events_ WHERE kind IN ('subject', 'unnamed') AND (kind = 'subject' OR slices >= 3) AND CASE WHEN confidence IS NOT NULL THEN confidence >= 0.3 ELSE kind <> 'subject' END AND (top_class = 'NATION_2' OR NOT EXISTS (SELECT 1 FROM events_ WHERE top_class = 'NATION_2'))")
def events_found(spark, sf_dir):
    """What was found, above the quality floor, of one species."""
    e = _events(spark, sf_dir)[1]
    kept = e.where(c.of_kind(F.col("kind"), "found") & c.good(F.col("kind"), F.col("slices"), F.col("confidence"), 0.3, 3))
    return c.of_species(kept, "NATION_2").select("name", "kind", F.coalesce("label", F.lit("")).alias("label"), F.col("s").cast("bigint").alias("s"))


@query(rec_sql(*_E) + "SELECT DISTINCT top_class AS taxon FROM events_ WHERE top_class <> ''")
def event_species(spark, sf_dir):
    return c.species(_events(spark, sf_dir)[1])


@query(rec_sql(*_E) + "SELECT e.name, e.kind, coalesce(e.label, '') AS label, e.s, l.dim_t AS t FROM events_ e JOIN slices l ON l.name = e.name AND l.dim_t BETWEEN e.from_t AND e.to_t AND (coalesce(e.top_class, '') = '' OR l.detection_top_class = e.top_class) WHERE l.detection_top_class IS NOT NULL")
def event_looks(spark, sf_dir):
    """The looks inside an event that are of its species."""
    e = _events(spark, sf_dir)[1]
    looks = adapt.slices(spark, sf_dir).where("detection_top_class is not null").select("name", F.col("dim_t").alias("t"), F.col("detection_top_class").alias("class"))
    return c.frames_of(e, looks).select("name", "kind", F.coalesce("label", F.lit("")).alias("label"), F.col("s").cast("bigint").alias("s"), F.col("r_t").alias("t"))


_SHOTS = "SELECT concat('c', CAST(dim_t AS VARCHAR), '-', CAST(i AS VARCHAR)) AS crop, detection_top_class AS class FROM (SELECT *, unnest(range(1, CAST(detection_count AS BIGINT) + 1)) AS i FROM (SELECT *, row_number() OVER (ORDER BY detection_confidence DESC NULLS LAST, name, dim_t) AS n FROM slices WHERE detection_count > 0) WHERE n <= 60) WHERE i <> 2 ORDER BY n, i LIMIT 20"


@query(with_sql(SLICES) + _SHOTS)
def preview_shots(spark, sf_dir):
    """The feature is a strip of twenty crops."""
    s = adapt.slices(spark, sf_dir)
    one = lambda i: F.struct(F.when(i != 2, F.concat_ws("-", F.concat(F.lit("c"), F.col("dim_t").cast("string")), i.cast("string"))).alias("crop"), F.col("detection_top_class").alias("class"))
    entries = F.when(F.col("detection_count") > 0, F.transform(F.sequence(F.lit(1), F.col("detection_count").cast("int")), one))
    return c.preview(s, entries, ["name", "dim_t"], 20)


@query("SELECT p_partkey, CASE WHEN p_size % 12 = 0 THEN []::INT[] WHEN p_size % 12 = 1 THEN [0]::INT[] ELSE list_sort(list_distinct(list_transform(range(0, k), lambda i: CASE WHEN i = k - 1 THEN n - 1 ELSE CAST(floor(i * ((n - 1) / (k - 1)::DOUBLE)) AS INT) END))) END AS picks FROM (SELECT p_partkey, p_size, CAST(p_size % 12 AS INT) AS n, CAST(least(5, p_size % 12) AS INT) AS k FROM part)")
def frame_picks(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", F.array_sort(c.picks((F.col("p_size") % 12).cast("int"), 5)).alias("picks"))


@query(with_sql(SLICES, TAXONOMY) + "SELECT phylum AS name, CAST(sum(detection_count) AS BIGINT) AS animals FROM slices JOIN taxonomy t ON t.name = detection_top_class GROUP BY phylum ORDER BY 2 DESC, 1 LIMIT 12")
def phylum_legend(spark, sf_dir):
    """The feature is a legend of twelve."""
    t = adapt.taxonomy(spark, sf_dir).select(F.col("name").alias("taxon"), "phylum")
    n = adapt.slices(spark, sf_dir).join(t, F.col("detection_top_class") == F.col("taxon")).groupBy(F.col("phylum").alias("name")).agg(F.sum("detection_count").cast("bigint").alias("animals"))
    return c.legend(n)


# --- joins of the page ------------------------------------------------------------------------


@query(with_sql(SIGHTINGS) + "SELECT ord, recording, row_number() OVER (PARTITION BY recording ORDER BY second, ord) - 1 AS reel, taxon, (n - 1) // 60 AS page, (n - 1) % 60 AS at FROM (SELECT *, row_number() OVER (PARTITION BY taxon ORDER BY confidence DESC, ord) AS n FROM sightings)")
def reel_places(spark, sf_dir):
    """Each animal of a recording's reel with its page and place in the store."""
    s = adapt.sightings(spark, sf_dir)
    store = hierarchy.pages(s.select("taxon", "confidence", "ord"), "taxon", "confidence", ["ord"]).select("ord", "page", "at")
    reel = (F.row_number().over(Window.partitionBy("recording").orderBy("second", "ord")) - 1).cast("bigint")
    return s.select("ord", "recording", reel.alias("reel"), "taxon").join(store, "ord")


@query(with_sql(SLICES) + "SELECT taxon, name, dim_t, strftime(recorded_at, '%Y-%m-%d %H:%M:%S') AS recorded_at, round(depth_m, 4) AS depth_m FROM (SELECT *, detection_top_class AS taxon, row_number() OVER (PARTITION BY detection_top_class ORDER BY detection_confidence DESC, name, dim_t) AS n FROM slices WHERE detection_top_class IS NOT NULL) WHERE n = 1")
def best_moments(spark, sf_dir):
    """The slice of each taxon's best look: when and how deep."""
    s = adapt.slices(spark, sf_dir)
    best = s.where("detection_top_class is not null").groupBy(F.col("detection_top_class").alias("taxon")).agg(F.min(F.struct((-F.col("detection_confidence")).alias("c"), "name", "dim_t")).alias("b")).select("taxon", "b.name", "b.dim_t")
    return best.join(s.select("name", "dim_t", "recorded_at", "depth_m"), ["name", "dim_t"]).select("taxon", "name", "dim_t", F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss").alias("recorded_at"), F.round("depth_m", 4).alias("depth_m"))


@query(with_sql(SIGHTINGS) + "SELECT taxon, page, count(*) AS tiles, CAST(sum(length(ord)) AS BIGINT) AS bytes, md5(CAST(string_agg(ord, '' ORDER BY place) AS VARCHAR)) AS digest FROM (SELECT taxon, ord, (n - 1) // 60 AS page, (n - 1) % 60 AS place FROM (SELECT *, row_number() OVER (PARTITION BY taxon ORDER BY confidence DESC, ord) AS n FROM sightings)) GROUP BY 1, 2")
def page_blobs(spark, sf_dir):
    """The pictures of each page in one blob."""
    s = adapt.sightings(spark, sf_dir).select("taxon", "confidence", "ord", F.col("ord").cast("binary").alias("picture"))
    b = sinks.page_blobs(hierarchy.pages(s, "taxon", "confidence", ["ord"]), "picture", ["taxon", "page"], ["at"])
    return b.select("taxon", "page", F.size("lengths").cast("bigint").alias("tiles"), F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("bytes"), F.md5("blob").alias("digest"))


@query("""WITH v AS (SELECT s_nationkey AS e, concat('c_', CAST(s_suppkey % 4 AS VARCHAR), CASE WHEN s_suppkey % 3 = 0 THEN '_x' ELSE '' END) AS stem, min(concat('http://h/', s_name)) AS url FROM supplier GROUP BY 1, 2),
a AS (SELECT c_custkey, c_nationkey AS e, concat('c_', CAST(c_custkey % 5 AS VARCHAR), '_x_1') AS recording FROM customer),
j AS (SELECT a.*, v.url, row_number() OVER (PARTITION BY c_custkey ORDER BY length(stem) DESC) AS n FROM a LEFT JOIN v ON v.e = a.e AND (recording = stem OR starts_with(recording, concat(stem, '_')) OR starts_with(recording, concat(stem, '-'))))
SELECT c_custkey, coalesce(url, '') AS url, CASE WHEN e % 2 = 0 THEN 640 ELSE 16 END AS wide, CASE WHEN e % 3 = 0 THEN r_name ELSE '' END AS credit FROM j JOIN nation ON n_nationkey = e JOIN region ON r_regionkey = n_regionkey WHERE n = 1""")
def sources_of_animals(spark, sf_dir):
    """Each animal's file in the archive, frame and terms."""
    e = lambda c: F.col(c).cast("string").alias("expedition")
    s = read(spark, sf_dir, "supplier")
    videos = s.select(e("s_nationkey"), F.concat(F.lit("c_"), (F.col("s_suppkey") % 4).cast("string"), F.when(F.col("s_suppkey") % 3 == 0, "_x").otherwise("")).alias("stem"), F.concat(F.lit("http://h/"), "s_name").alias("url"))
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    frames = n.where("n_nationkey % 2 = 0").select(e("n_nationkey"), F.array(F.lit(640), F.lit(360)).alias("frame"))
    terms = n.where("n_nationkey % 3 = 0").select(e("n_nationkey"), F.col("r_name").alias("credit"), F.lit("CC").alias("licence"))
    a = read(spark, sf_dir, "customer").select("c_custkey", e("c_nationkey"), F.concat(F.lit("c_"), (F.col("c_custkey") % 5).cast("string"), F.lit("_x_1")).alias("recording"))
    return gallery.where_from(a, videos, frames, terms).select("c_custkey", "url", F.get("frame", 0).alias("wide"), "credit")


# --- totals -----------------------------------------------------------------------------------

_ROWS = "rows AS (SELECT c_nationkey AS id, count(*) AS listed, count(*) FILTER (WHERE c_acctbal > 0 AND c_nationkey % 6 <> 0) AS processed, CAST(sum(c_custkey % 100) AS BIGINT) AS seconds, CAST(sum(c_custkey % 7) AS BIGINT) AS animals, count(*) FILTER (WHERE c_custkey % 7 > 0) AS with_animals, list(DISTINCT c_mktsegment) AS taxa FROM customer GROUP BY 1)"


def _rows(spark, sf_dir):
    k = F.col
    return read(spark, sf_dir, "customer").groupBy(k("c_nationkey").alias("id")).agg(F.count("*").alias("listed"), F.count_if((k("c_acctbal") > 0) & (k("c_nationkey") % 6 != 0)).alias("processed"), F.sum(k("c_custkey") % 100).cast("bigint").alias("seconds"), F.sum(k("c_custkey") % 7).cast("bigint").alias("animals"), F.count_if(k("c_custkey") % 7 > 0).alias("with_animals"), F.collect_set("c_mktsegment").alias("taxa"))


@query(f"WITH {_ROWS} SELECT CAST(sum(listed) AS BIGINT) AS listed, CAST(sum(processed) AS BIGINT) AS processed, CAST(sum(seconds) AS BIGINT) AS seconds, CAST(sum(animals) AS BIGINT) AS animals, CAST(sum(with_animals) AS BIGINT) AS with_animals, (SELECT CAST(count(DISTINCT t) AS INT) FROM (SELECT unnest(taxa) AS t FROM rows)) AS taxa, count(*) FILTER (WHERE processed > 0) AS ran FROM rows")
def collection_totals(spark, sf_dir):
    return c.totals(_rows(spark, sf_dir))


@query(f"WITH {_ROWS} SELECT id, round(CASE WHEN listed > 0 THEN processed * 100.0::DOUBLE / listed ELSE 0 END, 6) AS share FROM rows")
def expedition_shares(spark, sf_dir):
    return c.share(_rows(spark, sf_dir)).select("id", F.round("share", 6).alias("share"))


@query("SELECT CAST(c_nationkey AS VARCHAR) AS title, count(*) FILTER (WHERE c_acctbal > 5000) AS chosen, count(*) AS listed, count(DISTINCT CASE WHEN c_acctbal > 5000 AND c_custkey % 9 <> 0 THEN c_custkey % 9 END) AS dives FROM customer GROUP BY 1")
def chosen_of_listed(spark, sf_dir):
    v = read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("title"), F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey") % 9).alias("dive"), "c_acctbal")
    return c.chosen_of(v, v.where("c_acctbal > 5000"))


@query("SELECT count(*) AS reports, count(*) FILTER (WHERE s_acctbal < 0) AS failed, CAST(sum(s_suppkey % 40) FILTER (WHERE s_acctbal >= 0) AS BIGINT) AS animals, CAST(sum(s_nationkey) FILTER (WHERE s_acctbal >= 0) AS BIGINT) AS recordings, CAST(sum(s_suppkey * 10) FILTER (WHERE s_acctbal >= 0) AS BIGINT) AS bytes_before, CAST(sum(s_suppkey * 7) FILTER (WHERE s_acctbal >= 0) AS BIGINT) AS bytes_after FROM supplier")
def verb_totals(spark, sf_dir):
    k = F.col
    done = read(spark, sf_dir, "supplier").select(F.when(k("s_acctbal") < 0, "failed").alias("error"), (k("s_suppkey") % 40).alias("animals"), k("s_nationkey").alias("recordings"), (k("s_suppkey") * 10).alias("bytes_before"), (k("s_suppkey") * 7).alias("bytes_after"))
    t = c.verb_totals(done)
    return t.select("reports", "failed", *[F.col(n).cast("bigint").alias(n) for n in t.columns[2:]])


@query("SELECT count(DISTINCT c_nationkey) - count(DISTINCT s_nationkey) AS short, count(DISTINCT c_nationkey) AS groups FROM customer LEFT JOIN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 2000) ON s_nationkey = c_nationkey")
def groups_without_verdicts(spark, sf_dir):
    return c.lacking(read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("grp")), read(spark, sf_dir, "supplier").where("s_acctbal < 2000").select(F.col("s_nationkey").alias("grp")))


@query("SELECT id, md5(string_agg(part, ',' ORDER BY part)) AS parts, count(*) AS n FROM (SELECT c_nationkey AS id, c_mktsegment AS part FROM customer UNION SELECT s_nationkey, CAST(s_suppkey % 5 AS VARCHAR) FROM supplier) GROUP BY id")
def mixed_parts(spark, sf_dir):
    """Published and new parts of each expedition, every part once."""
    a = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("part"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("id"), (F.col("s_suppkey") % 5).cast("string").alias("part"))
    return c.mixed(a, b, ["id"], "part").select("id", F.md5(F.array_join("parts", ",").cast("binary")).alias("parts"), F.size("parts").cast("bigint").alias("n"))


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT DISTINCT s_suppkey * 20, 'theirs' FROM supplier WHERE s_suppkey * 20 NOT IN (SELECT c_custkey FROM customer)")
def favourites_taken_over(spark, sf_dir):
    held = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return c.taken_over(held, read(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 20).alias("k"), F.lit("theirs").alias("name")), "k")


# --- text -------------------------------------------------------------------------------------


@query("SELECT page_id, url GLOB '*[0-9]/*.ht?l*' AS numbered, url GLOB 'http*' AS web FROM pages")
def page_globs(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", x.glob(u, "*[0-9]/*.ht?l*").alias("numbered"), x.glob(u, "http*").alias("web"))


@query("""SELECT n_name, concat('<b>', n_name, '</b> lies at ', CASE WHEN hi - lo > 50 THEN concat(format('{:,}', CAST(round_even(lo, 0) AS BIGINT)), '-', format('{:,}', CAST(round_even(hi, 0) AS BIGINT)), ' m') ELSE concat(format('{:,}', CAST(round_even(hi, 0) AS BIGINT)), ' m') END, ', ', CASE WHEN a = b THEN a ELSE concat(a, ' to ', b) END) AS heading
FROM (SELECT n_name, min(s_acctbal) AS lo, max(s_acctbal) AS hi, '2020-01-01' AS a, concat('2020-01-0', CAST(1 + n_nationkey % 3 AS VARCHAR)) AS b FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name, n_nationkey)""")
def headings(spark, sf_dir):
    """A template filled with a depth range and a period."""
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name", "n_nationkey").agg(F.min("s_acctbal").alias("lo"), F.max("s_acctbal").alias("hi"))
    last = F.concat(F.lit("2020-01-0"), (1 + F.col("n_nationkey") % 3).cast("string"), F.lit("T12:00:00"))
    text = x.filled("<b>{{name}}</b> lies at {{depth}}, {{when}}", {"name": F.col("n_name"), "depth": x.depth_range(F.col("lo"), F.col("hi")), "when": x.period(F.lit("2020-01-01T00:00:00"), last)})
    return n.select("n_name", text.alias("heading"))
