"""One key with most of the rows: work must follow the rows, not their square."""

import random
import time

from pyspark.sql import functions as F

from benthos.operators import gallery, joins, link, triage
from benthos.sources import collection

ROWS = 100_000


def seconds(f):
    began = time.perf_counter()
    out = f()
    return time.perf_counter() - began, out


def test_asof_on_one_key(spark):
    left = spark.range(ROWS).select(F.lit("k").alias("k"), (F.col("id") * 3.0).alias("at"), "id")
    right = spark.range(ROWS).select(F.lit("k").alias("k"), (F.col("id") * 3.0 + 1).alias("at"), F.col("id").alias("fix"))
    took, out = seconds(lambda: joins.asof_nearest(left, right, "k", "at", 2.0, ["fix"]).agg(F.count("fix"), F.sum((F.col("fix") != F.col("id")).cast("int"))).first())
    assert tuple(out) == (ROWS, 0) and took < 30


def test_stretches_cut_no_pair(spark):
    rng = random.Random(4)
    left = [(i, rng.uniform(-5000, 5000)) for i in range(2000)]
    right = [(rng.uniform(-5000, 5000), i) for i in range(600)]
    a = spark.createDataFrame([("k", at, i) for i, at in left], "k string, at double, id long")
    b = spark.createDataFrame([("k", at, i) for at, i in right], "k string, at double, fix long")
    got = {r["id"]: r["fix"] for r in joins.asof_nearest(a, b, "k", "at", 10.0, ["fix"]).collect()}
    for i, at in left:
        near = min(right, key=lambda r: (abs(r[0] - at), r[0]))
        assert got[i] == (near[1] if abs(near[0] - at) <= 10 else None)


def test_constant_places_answer_always(spark):
    a = spark.createDataFrame([("k", 5.0), ("k", 500.0), ("m", 1.0), (None, 1.0)], "k string, at double")
    b = spark.createDataFrame([("k", 6.0, "track")], "k string, at double, fix string")
    c = spark.createDataFrame([("k", "mooring")], "k string, fix string")
    got = {(r["k"], r["at"]): r["fix"] for r in joins.asof_nearest(a, b, "k", "at", 20.0, ["fix"], c).collect()}
    assert got == {("k", 5.0): "track", ("k", 500.0): "mooring", ("m", 1.0): None, (None, 1.0): None}


def test_intervals_that_all_overlap(spark):
    n = 20_000
    left = spark.range(ROWS).select(F.lit("k").alias("k"), (F.col("id") % n).alias("at"), "id")
    right = spark.range(n).select(F.lit("k").alias("k"), (n - F.col("id")).alias("no"), F.col("id").alias("start"), F.lit(None).cast("long").alias("stop"))
    took, out = seconds(lambda: joins.interval_first(left, right, "at", "start", "stop", ["no"], ["id"], ["k"]).agg(F.count("no"), F.sum((F.col("no") != n - F.col("at")).cast("int"))).first())
    assert tuple(out) == (ROWS, 0) and took < 60  # a billion pairs


def test_recordings_of_one_camera_with_many_deployments(spark):
    n = 10_000
    day = lambda c: F.date_format(F.date_add(F.lit("1992-01-01"), c.cast("int")), "yyyy-MM-dd'T'HH:mm:ss")
    text = lambda v, name: F.lit(v).alias(name)
    register = spark.range(n).select(text("r", "Reference Designator"), (n - F.col("id")).cast("string").alias("deploymentNumber"), day(F.col("id")).alias("startDateTime"), text(" ", "stopDateTime"), text("44.5", "lat"), text("-125", "lon"), text("1", "deployment_depth"))
    recordings = spark.range(ROWS).select(F.col("id").alias("name"), F.lit("r").alias("ref"), F.date_add(F.lit("1992-01-01"), (F.col("id") % n).cast("int")).cast("timestamp_ntz").alias("recorded_at"))
    took, out = seconds(lambda: collection.deployed(recordings, register).agg(F.count("no"), F.sum((F.col("no") != n - F.col("name") % n).cast("int"))).first())
    assert tuple(out) == (ROWS, 0) and took < 60  # half a billion pairs


def test_left_rows_of_intervals_move_once_and_narrow(spark, monkeypatch):
    rng = random.Random(6)
    left = spark.createDataFrame([(rng.choice([*range(300), None]), rng.choice("abx"), rng.randint(0, 40)) for _ in range(400)], "id long, k string, at long")  # some keys are there twice
    right = spark.createDataFrame([(rng.choice("ab"), rng.choice([*range(9), None]), s, rng.choice([s + rng.randint(0, 9), None]), rng.random()) for s in (rng.randint(0, 40) for _ in range(60))], "k string, no int, start long, stop long, depth double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = []
        for few in (joins.FEW, 30, 0):  # all is few, the answers are many, the intervals are too
            monkeypatch.setattr(joins, "FEW", few)
            out = joins.interval_first(left, right, "at", "start", "stop", ["no"], ["id"], ["k"]).select("id", "no", "depth")
            told.append((sorted(map(str, out.collect())), out._jdf.queryExecution().executedPlan().toString()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert told[0][0] == told[1][0] == told[2][0] and len(told[0][0]) > 200
    assert "SortMergeJoin" not in told[0][1] and "SortAggregate" not in told[0][1] and "SortMergeJoin" in told[2][1]


def test_boxes_of_one_animal(spark):
    looks = spark.range(ROWS).select(F.lit("k").alias("k"), (F.col("id") * 1.0).alias("second"), *[F.col("id").cast("double").alias(c) for c in link.BOX])
    moments = spark.range(ROWS).select(F.lit("k").alias("k"), (F.col("id") + 0.5).alias("now"))
    took, out = seconds(lambda: gallery.box_at(looks, moments, "k").agg(F.sum(F.abs(F.col("x1") - F.col("now")))).first()[0])
    assert out < 1 and took < 30  # halfway between two looks, but for the last


def test_windows_of_one_long_recording(spark):
    kinds = [["dwell", "active", "subject"][i * 7 % 11 % 3] for i in range(ROWS)]
    runs = spark.createDataFrame([("r", k, "x" if k == "subject" else None, i * 3, i * 3 + i % 3) for i, k in enumerate(kinds)], "name string, kind string, label string, s int, e int")
    took, out = seconds(lambda: sorted((r["kind"], r["label"], r["s"], r["e"]) for r in triage.merged(runs).collect()))
    kept = []  # the rule as it reads
    for i, k in enumerate(kinds):
        s, e = i * 3, i * 3 + i % 3
        for w in reversed(kept):
            if s - w[2] - 1 > triage.MERGE_GAP:
                kept.append([k, s, e])
                break
            if w[0] == k:
                w[2] = max(w[2], e)
                break
        else:
            kept.append([k, s, e])
    assert [(k, s, e) for k, _, s, e in out] == sorted(map(tuple, kept)) and len(out) > 2 and took < 30


def test_tracking_of_one_long_recording_in_small_batches(spark):
    rows = spark.range(20_000).select(F.lit("r").alias("recording"), F.floor(F.col("id") / 2).cast("double").alias("second"), F.lit("a").alias("taxon"), (F.col("id") % 2 / 2 + 0.1).alias("confidence"), *[(F.col("id") % 2 * 300 + d).cast("double").alias(c) for c, d in zip(link.BOX, (0, 0, 50, 50))], F.col("id").cast("string").alias("ord"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "333")  # moments are cut by batches
    try:
        took, out = seconds(lambda: link.track(rows).groupBy("animal").count().collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, out)) == [(0, 10_000), (1, 10_000)] and took < 60
