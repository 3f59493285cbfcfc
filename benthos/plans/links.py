"""Queries that join: as-of, interval, prefix, lookups, matching, tracking, scores."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from benthos.functions.exprs import iou
from benthos.operators import hierarchy, joins, link

from . import adapt
from .adapt import SIGHTINGS, SLICES, TAXONOMY, read, with_sql
from .registry import query


@query("""WITH l AS (SELECT event_id, user_id, epoch_us(ts)/1000000.0::DOUBLE AS at FROM events WHERE event_type='purchase'), r AS (SELECT user_id, epoch_us(ts)/1000000.0::DOUBLE AS at, value FROM events WHERE event_type='signup'),
b AS (SELECT l.event_id, r.at AS b_at, r.value AS b_v FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.at >= r.at), a AS (SELECT l.event_id, r.at AS a_at, r.value AS a_v FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.at <= r.at)
SELECT l.event_id, l.user_id, CASE WHEN a_at IS NULL OR abs(l.at - b_at) <= abs(a_at - l.at) THEN CASE WHEN abs(l.at - b_at) <= 172800 THEN b_v END WHEN abs(a_at - l.at) <= 172800 THEN a_v END AS value FROM l JOIN b USING (event_id) JOIN a USING (event_id)""")
def asof_nearest(spark, sf_dir):
    """Purchases with the value of the same user's signup nearest in time, two days at most."""
    e = read(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "at")
    return joins.asof_nearest(left, e.where("event_type = 'signup'").select("user_id", "at", "value"), "user_id", "at", 172800.0, ["value"]).drop("at")


REGISTER = "reg AS (SELECT s_suppkey AS no, s_nationkey AS ref, TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey*37 % 2000 AS INT)) AS start, CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey*37 % 2000 + 400 AS INT)) END AS stop FROM supplier)"


def _register(spark, sf_dir):
    day = lambda n: F.expr(f"timestamp_ntz'1992-01-01' + make_dt_interval(cast({n} as int))")
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("no"), F.col("s_nationkey").alias("ref"), day("s_suppkey*37 % 2000").alias("start"), F.when(F.col("s_acctbal") >= 0, day("s_suppkey*37 % 2000 + 400")).alias("stop"))


@query(f"WITH {REGISTER} SELECT o_orderkey, no FROM (SELECT o_orderkey, no, row_number() OVER (PARTITION BY o_orderkey ORDER BY no) AS r FROM orders LEFT JOIN reg ON ref = CAST(o_custkey % 25 AS INT) AND o_orderdate >= start AND (stop IS NULL OR o_orderdate <= stop)) WHERE r = 1")
def interval_join(spark, sf_dir):
    """Each order with the first deployment of its instrument that covers its date."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", (F.col("o_custkey") % 25).cast("int").alias("ref"))
    return joins.interval_first(o, _register(spark, sf_dir), "o_orderdate", "start", "stop", ["no"], ["o_orderkey"], ["ref"]).select("o_orderkey", "no")


@query(with_sql(SIGHTINGS) + "SELECT a.ord, count(*) AS near, count(*) FILTER (WHERE b.taxon = a.taxon) AS same FROM sightings a JOIN sightings b ON a.recording = b.recording AND abs(a.second - b.second) < 0.06 WHERE a.is_truth GROUP BY a.ord")
def band_join(spark, sf_dir):
    """Detections within 0.06 s of each truth box. Moments are counted first, so boxes never meet boxes."""
    s = adapt.sightings(spark, sf_dir).select("recording", "second", "taxon", "ord", "is_truth")
    asked = s.where("is_truth").select("recording", "second", "taxon").distinct()
    all_of = s.groupBy("recording", "second").agg(F.count("*").alias("n"))
    alike = s.groupBy("recording", "taxon", "second").agg(F.count("*").alias("n"))
    near = joins.band(asked.select("recording", "second").distinct(), all_of, ["recording"], "second", 0.06).groupBy("recording", "second").agg(F.sum("r_n").alias("near"))
    same = joins.band(asked, alike, ["recording", "taxon"], "second", 0.06).groupBy("recording", "second", "taxon").agg(F.sum("r_n").alias("same"))
    return s.where("is_truth").join(near, ["recording", "second"]).join(same, ["recording", "second", "taxon"]).select("ord", "near", "same")


@query(with_sql(SLICES) + """, names AS (SELECT DISTINCT concat(name, '_', CAST(dim_t % 7 AS VARCHAR), '-a') AS name FROM slices), stems AS (SELECT DISTINCT name AS stem FROM slices UNION SELECT DISTINCT concat(name, '_', CAST(dim_t % 7 AS VARCHAR)) FROM slices WHERE detection_count > 0 UNION SELECT 'rec')
SELECT name, stem FROM (SELECT name, stem, row_number() OVER (PARTITION BY name ORDER BY length(stem) DESC) AS r FROM names LEFT JOIN stems ON name = stem OR starts_with(name, concat(stem, '_')) OR starts_with(name, concat(stem, '-'))) WHERE r = 1""")
def prefix_join(spark, sf_dir):
    s = adapt.slices(spark, sf_dir).withColumn("part", F.concat_ws("_", "name", (F.col("dim_t") % 7).cast("string")))
    names = s.select(F.concat("part", F.lit("-a")).alias("name")).distinct()
    stems = s.select(F.col("name").alias("stem")).union(s.where("detection_count > 0").select("part")).union(spark.createDataFrame([("rec",)], "stem string")).distinct()
    return joins.longest_prefix(names, stems, "name", "stem")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def remaining_work(spark, sf_dir):
    return joins.remaining(read(spark, sf_dir, "customer").select("c_custkey"), read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""SELECT coalesce(c.k, s.k) AS nation, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers, n_name FROM (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY 1) c
FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) s ON c.k = s.k LEFT JOIN nation ON n_nationkey = coalesce(c.k, s.k)""")
def progress_outer(spark, sf_dir):
    c = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    s = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    return c.join(s, "nation", "full_outer").join(n, "nation", "left").select("nation", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"), "n_name")


@query(with_sql(TAXONOMY) + "SELECT s_suppkey, s_name, coalesce(nullif(phylum, ''), 'no terms') AS phylum FROM supplier LEFT JOIN taxonomy ON name = concat('NATION_', CAST(s_nationkey AS VARCHAR))")
def lookup_default(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").withColumn("name", F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")))
    return joins.lookup(s, adapt.taxonomy(spark, sf_dir).select("name", "phylum"), "name", {"phylum": "no terms"}).select("s_suppkey", "s_name", "phylum")


@query(with_sql(SLICES) + "SELECT s.name, s.dim_t, n_name FROM slices s JOIN nation ON n_name = detection_top_class")
def known_taxa(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select("n_name")
    return adapt.slices(spark, sf_dir).join(n, F.col("detection_top_class") == F.col("n_name")).select("name", "dim_t", "n_name")


@query(with_sql(SLICES) + """, q AS (SELECT event_id, concat('rec_', CAST(user_id AS VARCHAR)) AS name, CAST(round(value) AS BIGINT) AS second FROM events)
SELECT q.event_id, q.name, s.dim_t, s.detection_top_class FROM q LEFT JOIN slices s ON s.name = q.name AND s.dim_t = q.second * 30""")
def slice_under(spark, sf_dir):
    """The slice under a position on a recording's own clock; null past its end."""
    q = read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("rec_"), F.col("user_id").cast("string")).alias("name"), (F.round("value").cast("bigint") * 30).alias("dim_t0"))
    s = adapt.slices(spark, sf_dir).select(F.col("name").alias("n"), "dim_t", "detection_top_class")
    return q.join(s, (F.col("n") == q["name"]) & (F.col("dim_t") == F.col("dim_t0")), "left").select("event_id", "name", "dim_t", "detection_top_class")


_IOU = "greatest(0, least(a.x2,b.x2)-greatest(a.x1,b.x1)) * greatest(0, least(a.y2,b.y2)-greatest(a.y1,b.y1))"
_AREA = "(({t}.x2-{t}.x1)*({t}.y2-{t}.y1))"
IOU_SQL = f"(({_IOU})::DOUBLE / ({_AREA.format(t='a')} + {_AREA.format(t='b')} - {_IOU}))"


@query(with_sql(SIGHTINGS) + f"""SELECT ord, animal, overlap FROM (SELECT a.ord, b.ord AS animal, round({IOU_SQL}, 6) AS overlap, row_number() OVER (PARTITION BY a.ord ORDER BY b.confidence DESC, {IOU_SQL} DESC, b.ord) AS r
  FROM sightings a JOIN sightings b ON a.recording = b.recording AND a.second = b.second AND NOT b.is_truth WHERE a.is_truth AND {IOU_SQL} >= 0.3) WHERE r = 1""")
def clip_to_animal(spark, sf_dir):
    """Each clip box with the most confident detection of its moment that overlaps it."""
    s = adapt.sightings(spark, sf_dir)
    a, b = s.where("is_truth").alias("a"), s.where("not is_truth").alias("b")
    box = lambda t: [F.col(f"{t}.{c}").cast("double") for c in link.BOX]
    j = a.join(b, (F.col("a.recording") == F.col("b.recording")) & (F.col("a.second") == F.col("b.second"))).select(F.col("a.ord").alias("ord"), F.col("b.ord").alias("animal"), F.col("b.confidence").alias("c"), iou(box("a"), box("b")).alias("o")).where("o >= 0.3")
    best = F.min(F.struct((-F.col("c")).alias("c"), (-F.col("o")).alias("o"), "animal"))
    return j.groupBy("ord").agg(best.alias("b")).select("ord", F.col("b.animal").alias("animal"), F.round(-F.col("b.o"), 6).alias("overlap"))


@query("""SELECT o_orderkey, coalesce(a.no, b.no) AS no, CASE WHEN a.no IS NOT NULL THEN 'track' WHEN b.no IS NOT NULL THEN 'path' END AS source FROM orders LEFT JOIN (SELECT l_orderkey AS k, min(l_suppkey) AS no FROM lineitem WHERE l_returnflag='R' GROUP BY 1) a ON a.k = o_orderkey
LEFT JOIN (SELECT l_orderkey AS k, min(l_suppkey) AS no FROM lineitem WHERE l_returnflag='A' GROUP BY 1) b ON b.k = o_orderkey""")
def priority_fallback(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    of = lambda f: li.where(F.col("l_returnflag") == f).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("no"))
    return joins.priority(read(spark, sf_dir, "orders").select("o_orderkey"), (of("R"), "track"), (of("A"), "path"), key="o_orderkey", columns=["no"])


@query("SELECT coalesce(s_suppkey, c_custkey) AS k, coalesce(s_name, c_name) AS name FROM customer FULL OUTER JOIN supplier ON c_custkey = s_suppkey")
def merge_over(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return joins.merge_over(c, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), "k")


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS depth_m, NULL::INT AS size FROM customer UNION ALL SELECT p_partkey, p_name, p_size::DOUBLE, p_size FROM part")
def union_parts(spark, sf_dir):
    from benthos.sources.parts import unify

    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("depth_m"))
    b = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_size").alias("depth_m"), F.col("p_size").alias("size"))
    return unify([a, b])


# --- individuals and scores -------------------------------------------------------------------


@query()
def tracked_animals(spark, sf_dir):
    """Individuals of every recording: greedy tracking is not SQL; tests hold it to a plain restatement."""
    return link.animals(link.track(adapt.sightings(spark, sf_dir).drop("is_truth")))


@query()
def tracked_names(spark, sf_dir):
    t = link.track(adapt.sightings(spark, sf_dir).drop("is_truth"), columns=["recording", "taxon", "confidence"])
    tax = adapt.taxonomy(spark, sf_dir)
    lin = hierarchy.lineages(tax, tax.select(F.col("name").alias("taxon"))).select(F.col("taxon").alias("name"), "lineage")
    return link.named(t, lin).withColumn("agreement", F.round("agreement", 6))


@query(with_sql(SIGHTINGS, TAXONOMY) + """, looks AS (SELECT recording, CAST(second * 4 AS BIGINT) AS animal, taxon, confidence FROM sightings), heard AS (SELECT * FROM (SELECT *, max(confidence) OVER (PARTITION BY recording, animal) AS best FROM looks) WHERE confidence >= best * 0.5),
w AS (SELECT recording, animal, taxon, sum(confidence) AS w FROM heard GROUP BY ALL)
SELECT recording, animal, CASE WHEN count(*) = 1 THEN min(taxon) WHEN count(phylum) = count(*) AND count(DISTINCT phylum) = 1 THEN CASE WHEN count(DISTINCT class) = 1 THEN min(class) ELSE min(phylum) END ELSE 'Undecided' END AS taxon,
  round(CASE WHEN count(*) = 1 THEN 1 ELSE max(w) / CASE WHEN sum(w) <> 0 THEN sum(w) ELSE 1 END END, 6) AS agreement FROM w LEFT JOIN taxonomy t ON t.name = w.taxon GROUP BY recording, animal""")
def resolved_names(spark, sf_dir):
    """What the looks of a moment agree on."""
    s = adapt.sightings(spark, sf_dir).withColumn("animal", (F.col("second") * 4).cast("bigint"))
    tax = adapt.taxonomy(spark, sf_dir)
    lin = hierarchy.lineages(tax, tax.select(F.col("name").alias("taxon"))).select(F.col("taxon").alias("name"), "lineage")
    return link.named(s, lin).withColumn("agreement", F.round("agreement", 6))


@query(with_sql(SIGHTINGS) + "SELECT recording, taxon, count(*) AS frames, max(confidence) AS confidence, arg_min(ord, {'c': -confidence, 's': second, 'o': ord}) AS best FROM sightings GROUP BY recording, taxon")
def best_sighting(spark, sf_dir):
    b = F.min(F.struct((-F.col("confidence")).alias("c"), "second", "ord"))
    return adapt.sightings(spark, sf_dir).groupBy("recording", "taxon").agg(F.count("*").alias("frames"), F.max("confidence").alias("confidence"), b.alias("b")).select("recording", "taxon", "frames", "confidence", F.col("b.ord").alias("best"))


@query(with_sql(SIGHTINGS) + "SELECT recording, second, count(*) AS shown FROM (SELECT *, row_number() OVER (PARTITION BY recording, second ORDER BY confidence DESC, ord) AS r FROM sightings) WHERE r <= 200 GROUP BY 1, 2")
def detections_capped(spark, sf_dir):
    """The feature is the detector's limit of 200 boxes a look."""
    w = Window.partitionBy("recording", "second").orderBy(F.desc("confidence"), "ord")
    return adapt.sightings(spark, sf_dir).withColumn("r", F.row_number().over(w)).where("r <= 200").groupBy("recording", "second").agg(F.count("*").alias("shown"))


def _judged(spark, sf_dir):
    s = adapt.sightings(spark, sf_dir)
    found = s.where("not is_truth").select("recording", "second", F.col("confidence").alias("conf"), "ord", *link.BOX)
    truth = s.where("is_truth").select("recording", "second", F.xxhash64("taxon").alias("track"), "ord", *link.BOX)
    return link.match_truth(found, truth, ["recording", "second"]), truth


_CLAIMED = f"""wanted AS (SELECT recording, second, list(struct_pack(ord, taxon, x1, y1, x2, y2)) AS truth FROM sightings WHERE is_truth GROUP BY 1, 2),
asked AS (SELECT *, row_number() OVER (PARTITION BY recording, second ORDER BY confidence DESC, ord) AS r FROM sightings WHERE NOT is_truth),
claim AS (SELECT recording, second, 0::BIGINT AS r, truth AS free, NULL::VARCHAR AS ord, NULL::DOUBLE AS conf, NULL::VARCHAR AS landed_on FROM wanted
  UNION ALL SELECT recording, second, r, CASE WHEN best IS NULL THEN free ELSE list_filter(free, lambda a: a.ord <> best.ord) END, ord, confidence, best.taxon
  FROM (SELECT c.recording, c.second, b.r, c.free, b.ord, b.confidence, list_max(list_transform(list_filter(c.free, lambda a: {IOU_SQL} >= 0.3::DOUBLE), lambda a: struct_pack(over := {IOU_SQL}, ord := a.ord, taxon := a.taxon))) AS best
    FROM claim c JOIN asked b ON b.recording = c.recording AND b.second = c.second AND b.r = c.r + 1)),
judged AS (SELECT recording, second, ord, conf, landed_on FROM claim WHERE r > 0 UNION ALL SELECT a.recording, a.second, a.ord, a.confidence, NULL FROM asked a WHERE NOT EXISTS (SELECT 1 FROM wanted w WHERE w.recording = a.recording AND w.second = a.second))"""


@query("WITH RECURSIVE " + ",\n".join([SIGHTINGS, _CLAIMED]) + """, d AS (SELECT recording, count(*) AS detections, count(landed_on) AS matched, count(DISTINCT landed_on) AS found, count(DISTINCT second) AS looked FROM judged GROUP BY 1),
t AS (SELECT recording, count(*) AS boxes FROM sightings s WHERE is_truth AND EXISTS (SELECT 1 FROM judged j WHERE j.recording = s.recording AND j.second = s.second) GROUP BY 1), w AS (SELECT recording, count(*) AS boxes, count(DISTINCT taxon) AS animals, count(DISTINCT second) AS frames FROM sightings WHERE is_truth GROUP BY 1)
SELECT recording, detections, matched, round(matched::DOUBLE / detections, 6) AS precision, round(matched::DOUBLE / t.boxes, 6) AS recall, round(matched::DOUBLE / w.boxes, 6) AS recall_overall, round(found::DOUBLE / animals, 6) AS recall_animals, round(looked::DOUBLE / frames, 6) AS looked_at FROM w LEFT JOIN d USING (recording) LEFT JOIN t USING (recording)""")
def truth_scores(spark, sf_dir):
    """Precision and recall of each recording, each truth box claimed once."""
    judged, truth = _judged(spark, sf_dir)
    d = judged.groupBy("recording").agg(F.count("*").alias("detections"), F.count("landed_on").alias("matched"), F.count_distinct("landed_on").alias("animals_found"), F.count_distinct("second").alias("frames_judged"))
    seen = judged.select("recording", "second").distinct()
    t = truth.join(seen, ["recording", "second"], "left_semi").groupBy("recording").agg(F.count("*").alias("truth_boxes"))
    whole = truth.groupBy("recording").agg(F.count("*").alias("truth_boxes_all"), F.count_distinct("track").alias("animals_all"), F.count_distinct("second").alias("frames_annotated"))
    x = whole.join(d, "recording", "left").join(t, "recording", "left")
    r = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return x.select("recording", "detections", "matched", r("matched", "detections").alias("precision"), r("matched", "truth_boxes").alias("recall"), r("matched", "truth_boxes_all").alias("recall_overall"), r("animals_found", "animals_all").alias("recall_animals"), r("frames_judged", "frames_annotated").alias("looked_at"))


@query("WITH RECURSIVE " + ",\n".join([SIGHTINGS, _CLAIMED]) + """, n AS (SELECT recording, count(*) AS boxes FROM sightings WHERE is_truth GROUP BY 1), c AS (SELECT j.recording, round(conf, 5) AS confidence, rank, hits::DOUBLE / rank AS precision, coalesce(hits::DOUBLE / nullif(boxes, 0), 0) AS recall
  FROM (SELECT *, row_number() OVER w AS rank, count(landed_on) OVER (PARTITION BY recording ORDER BY conf DESC, ord ROWS UNBOUNDED PRECEDING) AS hits FROM judged WINDOW w AS (PARTITION BY recording ORDER BY conf DESC, ord)) j LEFT JOIN n USING (recording))
SELECT recording, b.recall AS recall, b.confidence AS confidence FROM (SELECT recording, max(struct_pack(recall, confidence)) FILTER (WHERE precision >= 0.1::DOUBLE) AS b FROM c GROUP BY recording)""")
def truth_curve_points(spark, sf_dir):
    judged, truth = _judged(spark, sf_dir)
    j = judged.select("recording", "conf", "ord", F.col("landed_on").isNotNull().alias("hit"))
    c = link.curve(j, truth.groupBy("recording").agg(F.count("*").alias("truth_boxes")), ["recording"])
    return link.at_precision(c, 0.1, ["recording"])


CURVE = """judged AS (SELECT d.lang, CAST(n_chars % 1000 AS DOUBLE)/1000 AS conf, lpad(CAST(d.doc_id AS VARCHAR), 12, '0') AS ord, quality = 1 AS hit FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
total AS (SELECT lang, count(*) FILTER (WHERE hit) AS truth_boxes FROM judged GROUP BY lang),
curve AS (SELECT j.lang, round(conf, 5) AS confidence, rank, hits::DOUBLE / rank AS precision, coalesce(hits::DOUBLE / nullif(truth_boxes, 0), 0) AS recall FROM (SELECT *, row_number() OVER w AS rank, sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER w AS hits FROM judged WINDOW w AS (PARTITION BY lang ORDER BY conf DESC, ord)) j JOIN total t ON t.lang = j.lang)"""


def _curve(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    j = d.select("lang", ((F.col("n_chars") % 1000).cast("double") / 1000).alias("conf"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("ord"), (F.col("quality") == 1).alias("hit"))
    return link.curve(j, j.groupBy("lang").agg(F.count_if("hit").alias("truth_boxes")), ["lang"])


@query(f"WITH {CURVE} SELECT lang, confidence, rank, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve")
def pr_curve(spark, sf_dir):
    return _curve(spark, sf_dir).select("lang", "confidence", F.col("rank").cast("bigint").alias("rank"), F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(f"WITH {CURVE} SELECT lang, round(b.recall, 6) AS recall, b.confidence AS confidence FROM (SELECT lang, max({{'recall': recall, 'confidence': confidence}}) FILTER (WHERE precision >= 0.8) AS b FROM curve GROUP BY lang)")
def recall_at_precision(spark, sf_dir):
    return link.at_precision(_curve(spark, sf_dir), 0.8, ["lang"]).withColumn("recall", F.round("recall", 6))
