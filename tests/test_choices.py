"""Small cases of choices, roll-ups, links, walks and scores that the twins' tables don't reach."""

import math

import pytest
from pyspark.sql import functions as F

from benthos.functions import exprs as x
from benthos.operators import choices, gallery, joins, link, reports
from benthos.operators import rollups as r
from benthos.sources import listings, parts, sinks


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_rollups_of_nothing_and_of_ties(spark):
    k = F.col
    rows = [("a", 1, 5.0, 0.0, None, "", None), ("a", 2, float("nan"), 2.0, 0.4, "x", 7.0), ("a", 3, 3.0, 2.0, 0.4, "y", None), ("b", 1, None, 1.0, -1.0, "z", 1.0), ("b", 2, None, 1.0, None, None, 2.0)]
    df = spark.createDataFrame(rows, "g string, o int, v double, w double, c double, p string, tone double")
    out = {t["g"]: t for t in df.groupBy("g").agg(r.weighted_mean(k("v"), k("w")).alias("m"), r.nan_max(k("v")).alias("top"), r.of_surest(k("p"), k("c"), k("o")).alias("p"), r.channel(k("tone"), k("o") - 1, k("o"), 0).alias("tone"), r.shared(k("p"), k("o")).alias("s")).collect()}
    assert (out["a"]["m"], out["a"]["top"], out["a"]["p"], out["a"]["tone"], out["a"]["s"]) == (3.0, 5.0, "x", 7.0, "x")
    assert (out["b"]["m"], out["b"]["top"], out["b"]["p"], out["b"]["tone"]) == (None, None, None, 1.0)  # a certainty of -1 never wins


def test_kinds_quality_and_species(spark):
    e = spark.createDataFrame([("subject", 1, None, "a"), ("subject", 1, 0.9, "a"), ("unnamed", 1, None, None), ("unnamed", 5, float("nan"), None), ("dwell", 9, None, "b")], "kind string, slices int, confidence double, top_class string")
    kept = lambda floor, least: e.where(choices.good(F.col("kind"), F.col("slices"), F.col("confidence"), floor, least)).count()
    assert (kept(0, 1), kept(0, 3), kept(0.5, 3)) == (5, 4, 3)
    assert e.where(choices.of_kind(F.col("kind"), "found")).count() == 4 and e.where(choices.of_kind(F.col("kind"), "dwell")).count() == 1
    assert [choices.of_species(e, s).count() for s in ("all", "a", "gone")] == [5, 2, 5]
    assert [t["taxon"] for t in choices.species(e).collect()] == ["a", "b"]


def test_legend_needs_two(spark):
    b = spark.createDataFrame([("a", 5), ("", 9), (None, 9)], "name string, animals int")
    assert choices.legend(b).count() == 0 and choices.legend(b.union(spark.createDataFrame([("c", 7)], b.schema))).count() == 2
    assert choices.measures(["depth_m", "x", "frame_difference"]) == ["frame_difference", "depth_m"]
    assert choices.offers("profile", ["depth_m", "dim_t"]) and not choices.offers("biodiversity", ["dim_t"])


def test_templates_and_addresses(spark):
    assert one(spark, x.filled("{{a}} of {{ b }} {{c_1}}!", {"a": F.lit(3), "c_1": F.lit("x")}))[0] == "3 of {{ b }} x!"
    with pytest.raises(KeyError):
        x.filled("{{missing}}", {})
    assert x.data_url("", "p.parquet") == "../p.parquet" and x.data_url("http://a/", "p") == "http://a/p"
    assert one(spark, x.report_url(F.lit("p"), ["a", "b"], "expedition"))[0] == "viewer/index.html?data=p&hidden=a.b&group=expedition"
    assert one(spark, x.extent(*map(F.lit, (1.0, 2.0, 1.0, 1.1, 1.9, 2.1, 0.2))))[0] == "1.000°N 2.000°E"
    assert one(spark, x.extent(*map(F.lit, (1.0, 2.0, -1.0, 1.0, 1.0, 3.0, 2.0))))[0] == "1.000°S to 1.000°N, 1.000°E to 3.000°E"


def test_labels_without_years(spark):
    titles = {"Deep Sea, 2021": "Deep Sea", "A 2019-2021": "A", "A 2019 – 2021": "A", "A 1999 2021": "A 1999", "2021": "2021", "Route 66": "Route 66", "X2021": "X2021", "A,2019 -  2020": "A", "A 2150": "A 2150"}
    got = {t["t"]: t["n"] for t in spark.createDataFrame([(t,) for t in titles], "t string").select("t", x.without_year(F.col("t")).alias("n")).collect()}
    assert got == titles


def test_positions(spark):
    lines = {"28.25 ; -79.5": (28.25, -79.5), "28°, 15.064' N ; 79°, 36.072' W": (28 + 15.064 / 60, -(79 + 36.072 / 60)), "79 36.0' W;28 15.0' S": (-28.25, -79.6), "N/A ; N/A": None, "": None, "1;2;3": None, "5.0' N ; 6 7.0' E": None}
    got = {t["t"]: t["p"] for t in spark.createDataFrame([(t,) for t in lines], "t string").select("t", x.position(F.col("t")).alias("p")).collect()}
    for t, want in lines.items():
        assert (got[t] is None) == (want is None) and (want is None or all(math.isclose(a, b) for a, b in zip(got[t], want))), t


def test_links_are_read_back(spark):
    rows = F.array(F.struct(F.lit("é/+").alias("e"), F.lit(1.5).alias("s")))
    kind = "array<struct<e:string,s:double>>"
    for deflate in (False, True):
        link_ = spark.range(1).select(gallery.share_link(rows, deflate).alias("l"))
        text = link_.first()[0]
        assert text[0] == "pz"[deflate] and not set(text) & set("+/=\n")
        assert link_.select(gallery.unshared(F.col("l"), kind)).first()[0][0].asDict() == {"e": "é/+", "s": 1.5}
    assert spark.createDataFrame([("z!!",), ("zAAAA",), ("p",)], "l string").select(gallery.unshared(F.col("l"), kind).alias("v")).where("v is not null").count() == 0


def test_walks_go_as_deep_as_asked(spark):
    pages = [("http://a/x/", '<a href="?C=N">n</a><a href="../">up</a><a href="/abs/">x</a><a href="one/">1</a><a href="two/">2</a><a href="v.mp4">v</a>'), ("http://a/x/one/", '<a href="a.mp4">a</a><a href="b.MP4">b</a><a href="deeper/">d</a>'), ("http://a/x/two/", '<a href="c.mp4">c</a>')]
    df = spark.createDataFrame(pages, "url string, html string")
    walk = lambda d, p: [t["url"] for t in listings.walk(df, "http://a/x/", d, p).collect()]
    assert walk(0, "*.mp4") == ["http://a/x/v.mp4"]
    assert walk(1, "*.mp4") == ["http://a/x/one/a.mp4", "http://a/x/two/c.mp4"] and walk(2, "*") == []


def test_tracks_survive_a_csv(spark, tmp_path):
    t = spark.createDataFrame([(1.0, 10.5, 20.25, 300.0), (2.0, 1.0, 2.0, None)], "unixtime double, latitude double, longitude double, depth_m double")
    sinks.write_csv(t, f"{tmp_path}/t")
    back = listings.navigation(spark.read.option("header", "true").csv(f"{tmp_path}/t"))
    assert sorted(map(tuple, back.select(t.columns).collect())) == sorted(map(tuple, t.collect()))


def test_parts_leave_sightings_out(spark, tmp_path):
    for name in ("a", "sightings/b", "_c"):
        spark.range(2).coalesce(1).write.parquet(f"{tmp_path}/r/{name}")
    assert parts.read_parts(spark, f"{tmp_path}/r").count() == 2
    assert parts.not_null(spark.createDataFrame([(1, None), (2, 3)], "a int, b int"), ["a", "b", "c"]).first()[:] == (2, 1, 0)


def test_a_report_scored_against_truth(spark):
    det = lambda s, c, x1: f'{{"second":{s},"class":"fish","conf":{c},"box":[{x1},0,{x1 + 10},10]}}'
    report = spark.createDataFrame([("v", 0, 10.0, "[" + ",".join([det(0.0, 0.9, 0), det(0.0, 0.8, 0), det(0.04, 0.7, 50)]) + "]"), ("v", 10, 10.0, "[" + det(5.0, 0.9, 0) + "]")], "name string, dim_t long, fps double, detections string")
    box = lambda f, t, x1: ("v", f, t, f"{f}{t}", float(x1), 0.0, float(x1 + 10), 10.0)
    truth = spark.createDataFrame([box(1, 7, 0), box(1, 8, 50), box(1, 9, 200), box(9, 7, 0)], "recording string, frame long, track long, ord string, x1 double, y1 double, x2 double, y2 double")
    scores, judged = reports.scored(report, truth)
    s = scores.first()
    assert (s["detections"], s["matched"], s["truth_boxes"], s["truth_boxes_all"], s["animals_found"], s["frames_judged"], s["frames_annotated"]) == (3, 2, 3, 4, 2, 1, 2)
    assert math.isclose(s["precision"], 2 / 3) and math.isclose(s["recall"], 2 / 3) and s["recall_overall"] == 0.5
    empty = reports.scored(report.limit(0), truth)[0].first()
    assert empty["detections"] == 0 and empty["precision"] is None and empty["recall_overall"] == 0.0
    one_ = link.pooled(judged, scores.select("recording", "truth_boxes"), scores, 0.9).first()
    assert one_["at_floor"] == 1 / 3 and math.isclose(one_["overall_at_floor"], 0.25)


def test_moments_without_a_start_or_rate(spark):
    s = spark.createDataFrame([("a", 60, 30.0), ("a", 60, None), ("b", 0, 30.0)], "name string, dim_t long, fps double")
    at = spark.createDataFrame([("a", 100.0)], "name string, start double")
    fix = spark.createDataFrame([("a", 101.0, 5.0)], "name string, at double, latitude double")
    got = sorted(((t["name"], t["fps"], t["recorded_at"], t["latitude"]) for t in joins.placed_moments(s, at, fix, 20.0, ["latitude"]).collect()), key=str)
    assert got == sorted([("a", 30.0, 102.0, 5.0), ("a", None, 100.0, 5.0), ("b", 30.0, None, None)], key=str)


def test_jobs_fit_in_memory():
    assert [reports.jobs_that_fit(a, f) for a, f in ((8, 13.0), (2, 100.0), (4, 1.0))] == [2, 2, 1]
