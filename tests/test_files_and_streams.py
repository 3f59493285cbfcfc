import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from benthos import schema
from benthos.operators import link, reports
from benthos.sources import listings, parts, sinks
from benthos.streaming import jobs
from tests.test_link import S, random_sightings


def test_parts_unify_and_bad_files_are_passed_over(spark, tmp_path):
    a = spark.createDataFrame([("a", 1)], "name string, depth_m int")
    b = spark.createDataFrame([("b", 2.5, "x")], "name string, depth_m double, extra string")
    u = parts.unify([a, b])
    assert dict(u.dtypes) == {"name": "string", "depth_m": "double", "extra": "string"} and u.count() == 2
    root = f"{tmp_path}/r"
    a.coalesce(1).write.parquet(f"{root}/one")
    good = next((tmp_path / "r/one").glob("*.parquet"))
    (tmp_path / "r/cut.parquet").write_bytes(good.read_bytes()[:50])
    (tmp_path / "r/empty.parquet").write_bytes(b"")
    (tmp_path / "r/text.parquet").write_bytes(b"hello world")
    why = {r["path"].rsplit("/", 1)[1]: r["why"] for r in parts.unreadable(spark, root).collect()}
    assert why == {"cut.parquet": "cut off: the end is missing", "text.parquet": "not a parquet file"}


def test_replace_keeps_the_old_result_when_a_write_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    sinks.replace(spark.read.parquet(path).withColumn("x", F.lit(1)), path)  # reads what it replaces
    assert spark.read.parquet(path).columns == ["id", "x"]
    with pytest.raises(Exception):
        sinks.replace(spark.range(3).select(F.raise_error(F.lit("no"))), path)
    assert spark.read.parquet(path).count() == 3
    sinks.write_meta(spark, path, {"project_name": "p"})
    assert sinks.read_meta(spark, path) == {"project_name": "p"} and sinks.read_meta(spark, f"{tmp_path}/none") == {}


def test_identify_twice_changes_nothing_and_clips_inherit(spark):
    det = lambda *d: "[" + ",".join(d) + "]"
    rows = [("v", i * 30, 30.0, det(f'{{"second":{i}.0,"frame":{i * 30},"class":"fish","conf":0.9,"box":[{10 + i},10,{50 + i},50]}}', f'{{"second":{i}.1,"class":"fish","of":0,"clip":1,"box":[0,0,5,5]}}')) for i in range(3)] + [("w", 0, 30.0, None), ("w", 30, 30.0, "not json")]
    report = spark.createDataFrame(rows, "name string, dim_t long, fps double, detections string")
    lin = spark.createDataFrame([("fish", ["Animalia", "Chordata", "fish"])], "name string, lineage array<string>")
    once = reports.identify(report, lin)
    flat = once.where("name = 'v'").select("dim_t", F.explode(schema.detections(F.col("detections"))).alias("d")).collect()
    assert {r["d"]["animal"] for r in flat} == {0} and {r["d"]["animal_taxon"] for r in flat} == {"fish"} and len(flat) == 6
    assert sorted(map(str, reports.identify(once, lin).collect())) == sorted(map(str, once.collect()))
    assert reports.has_ids(once) and not reports.has_ids(report)
    assert reports.without_clips(report).where("detections like '%clip%'").count() == 0
    assert reports.progress(report).first()["animals"] == 1


def test_readers(spark):
    lines = spark.createDataFrame([("1,7,10,20,30,40,1,1,1",), ("bad line",), ("2,7,1,2,x,4",), ("3,8,0,0,5,5",)], "value string")
    assert sorted((r["frame"], r["track"], r["x2"], r["y2"]) for r in listings.truth(lines).collect()) == [(1, 7, 40.0, 60.0), (3, 8, 5.0, 5.0)]
    nav = spark.createDataFrame([("1.0", "10.5", "20.5", "-300"), ("2.0", "", "3", "4"), ("3", "1", "2", "nan")], ["time (unix sec)", "lat (dec. deg.)", " lon (dec. deg.)", "depth (m)"])
    assert sorted((r["unixtime"], r["depth_m"]) for r in listings.navigation(nav).collect()) == [(1.0, 300.0), (3.0, None)]
    text = "Max Vehicle Depth: 4012.5 m\nOn Bottom:  2021-07-31T14:00:00\n  28.25 ; -79.5\nOff Bottom: 2021-07-31T20:00:00\n N/A ; N/A\n"
    s = listings.dive_summary(spark.createDataFrame([(text,)], "text string")).first()
    assert s["max_depth_m"] == 4012.5 and tuple(s["on_bottom_position"]) == (28.25, -79.5) and s["off_bottom_position"] is None and s["off_bottom_at"].startswith("2021")
    k = listings.kml_points(spark.createDataFrame([("<coordinates> 1,2,3 4,5 x,1 </coordinates>",)], "text string"))
    assert [(r["longitude"], r["latitude"]) for r in k.orderBy("pos").collect()] == [(1.0, 2.0), (4.0, 5.0)]
    assert '"coordinates":[[[1.0,2.0],[4.0,5.0],[4.0,5.0],[1.0,2.0]]]' in listings.path_polygon(k, []).first()["footprint"]
    c = listings.catalogue(spark, "- {id: EX1, title: 'A: b', surprise: 1}\n- {id: EX2}")
    assert [r["title"] for r in c.orderBy("id").collect()] == ["A: b", None]


def test_ensure_adds_what_is_missing(spark):
    e = schema.ensure(spark.createDataFrame([("a", 1)], "name string, own int"))
    assert e.select("dim_t", "depth_m", "own").first() == (None, None, 1)


def test_streamed_tracks_equal_batch_tracks(spark, tmp_path):
    rows = [r for r in random_sightings(random.Random(5), 3, 80)]
    df = spark.createDataFrame(rows, S)
    root = f"{tmp_path}/in"
    for i, (lo, hi) in enumerate([(0, 3), (3, 40), (40, 1e9)]):  # arrives in time order, file by file
        df.where((F.col("second") >= lo) & (F.col("second") < hi)).coalesce(1).write.mode("append").parquet(f"{root}/{i}")
    stream = jobs.parts(spark, root, df.schema, per_batch=100)
    out = jobs.run_once(jobs.tracked(stream, 2.0), "tracked_test", "append", f"{tmp_path}/cp")
    got = {r["ord"]: r["animal"] for r in out.collect()}
    want = {r["ord"]: r["animal"] for r in link.track(df, gap=2.0).collect()}
    assert got == want


def test_only_new_parts_are_read(spark, tmp_path):
    root, cp = f"{tmp_path}/in", f"{tmp_path}/cp"
    spark.range(3).coalesce(1).write.parquet(f"{root}/a")
    stream = lambda: jobs.parts(spark, root, "id long")
    seen = []
    go = lambda: stream().writeStream.option("checkpointLocation", cp).trigger(availableNow=True).foreachBatch(lambda d, _: seen.append(d.count())).start().awaitTermination()
    go()
    spark.range(5).coalesce(1).write.parquet(f"{root}/b")
    go()
    assert sum(seen) == 8 and seen[-1] == 5
