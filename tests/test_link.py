"""The tracker, naming, truth matching, curves and fusion against plain restatements."""

import math
import random
import time

import numpy as np
import pytest

from benthos.operators import link

S = "recording string, second double, taxon string, confidence double, x1 int, y1 int, x2 int, y2 int, ord string"


def overlap(a, b):
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / u if u > 0 else 0.0


def plain_gap(seconds):
    looks = []
    for s in sorted(set(seconds)):
        if not looks or s - looks[-1] > 0.2:
            looks.append(s)
    if len(looks) < 2:
        return 1.5
    steps = sorted(b - a for a, b in zip(looks, looks[1:]))
    return min(30.0, max(1.5, steps[len(steps) // 2] * 2.5))


def plain_tracks(rows):
    """rows of one recording -> ord -> animal"""
    gap, out, tracks, n = plain_gap([r[1] for r in rows]), {}, [], 0
    for second in sorted({r[1] for r in rows}):
        tracks = [t for t in tracks if second - t[1] <= gap]
        for r in sorted((r for r in rows if r[1] == second), key=lambda r: (-r[3], r[8])):
            box, best, hit = r[4:8], 0.0, None
            for t in tracks:
                if t[1] >= second:
                    continue
                o = overlap(t[2], box)
                if t[3] == r[2]:
                    if o >= 0.15:
                        score = 1 + o
                    else:
                        span = max(1.0, (t[2][2] - t[2][0] + box[2] - box[0]) / 2)
                        moved = math.hypot((t[2][0] + t[2][2] - box[0] - box[2]) / 2, (t[2][1] + t[2][3] - box[1] - box[3]) / 2)
                        score = max(0.0, 1 - moved / (span * 3))
                else:
                    score = 1 + o if o >= 0.3 else 0.0
                if score > best:
                    best, hit = score, t
            if hit is None:
                tracks.append([n, second, box, r[2]])
                out[r[8]] = n
                n += 1
            else:
                hit[1], hit[2] = second, box
                out[r[8]] = hit[0]
    return out


def random_sightings(rng, recordings=6, n=150):
    out = []
    for k in range(recordings):
        step = rng.choice([0.1, 1.0, 5.0])
        for i in range(n):
            x, y, w = rng.randint(0, 300), rng.randint(0, 200), rng.randint(5, 80)
            out.append((f"r{k}", round(rng.randint(0, 30) * step, 3), rng.choice("abc"), rng.choice([0.2, 0.5, 0.9]), x, y, x + w, y + rng.randint(5, 80), f"{k}-{i:04d}"))
    return out


def test_tracks_match_a_plain_tracker(spark):
    rows = random_sightings(random.Random(2))
    got = {r["ord"]: r["animal"] for r in link.track(spark.createDataFrame(rows, S).repartition(3)).collect()}
    for k in {r[0] for r in rows}:
        want = plain_tracks([r for r in rows if r[0] == k])
        assert {o: got[o] for o in want} == want


def test_small_cases(spark):
    drift = [("r", i * 0.25, "fish", 0.9, 10 + i, 10, 50 + i, 50, f"{i}") for i in range(8)]
    a = link.animals(link.track(spark.createDataFrame(drift, S))).collect()
    assert len(a) == 1 and a[0]["frames"] == 8 and a[0]["seconds"] == 1.75
    renamed = [("r", 0.0, "x", 0.9, 10, 10, 50, 50, "0"), ("r", 0.5, "y", 0.9, 10, 10, 50, 50, "1")]
    assert link.track(spark.createDataFrame(renamed, S)).select("animal").distinct().count() == 1
    beside = [("r", 0.0, "x", 0.9, 10, 10, 50, 50, "0"), ("r", 0.5, "y", 0.9, 55, 10, 95, 50, "1")]
    assert link.track(spark.createDataFrame(beside, S)).select("animal").distinct().count() == 2
    arm = [("r", i * 0.5, "fish", 0.9, 0, 10, 50, 50, f"{i:02d}") for i in range(40)]
    assert link.animals(link.track(spark.createDataFrame(arm, S))).first()["vehicle"]


@pytest.mark.parametrize(("looks", "want"), [
    ([("keratoisis", 0.8), ("keratoisis", 0.5)], ("keratoisis", 1.0)),
    ([("keratoisis", 0.8), ("black coral", 0.7)], ("Cnidaria", 0.8 / 1.5)),
    ([("keratoisis", 0.8), ("fish", 0.7)], ("Undecided", 0.8 / 1.5)),
    ([("keratoisis", 0.8), ("fish", 0.1)], ("keratoisis", 1.0)),
    ([("mystery", 0.8), ("riddle", 0.8)], ("Undecided", 0.5)),
    ([("", 0.8)], ("Undecided", 0.0)),
])
def test_names(spark, looks, want):
    rows = [("r", float(i), t, c, 0, 0, 9, 9, str(i), 0) for i, (t, c) in enumerate(looks)]
    lin = spark.createDataFrame([("keratoisis", ["Animalia", "Cnidaria", "keratoisis"]), ("black coral", ["Animalia", "Cnidaria", "black coral"]), ("fish", ["Animalia", "Chordata", "fish"])], "name string, lineage array<string>")
    r = link.named(spark.createDataFrame(rows, S + ", animal long"), lin).first()
    assert r["taxon"] == want[0] and abs(r["agreement"] - want[1]) < 1e-9


def test_names_track_once_and_send_what_they_need(spark):
    rows = [(*r[:2], random.Random(r[8]).choice([r[2], "", None]), *r[3:]) for r in random_sightings(random.Random(5), 3, 60)]
    rows += [(None, 1.0, "a", 0.9, 0, 0, 9, 9, "x"), ("r0", None, "b", 0.9, 0, 0, 9, 9, "y")]
    lin = spark.createDataFrame([("a", ["Animalia", "p", "a"]), ("b", ["Animalia", "p", "b"])], "name string, lineage array<string>")
    df = spark.createDataFrame(rows, S)
    whole, few = link.track(df), link.track(df, columns=["recording", "taxon", "confidence"])
    assert few.columns == ["recording", "taxon", "confidence", "animal"] and whole.columns == [*df.columns, "animal"]
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.select(few.columns).collect())) and whole.count() == len(rows)
    named = link.named(link.track(df, gap=2.0, columns=few.columns[:3]), lin)
    assert named._jdf.queryExecution().optimizedPlan().toString().count("MapIn") == 1
    assert named.count() == link.track(df, gap=2.0).select("recording", "animal").distinct().count()
    assert named.where("taxon is null or agreement is null").count() == 0 and named.where("taxon = 'Undecided'").count() > 0


def plain_match(found, truth):
    taken, out = set(), {}
    for f in sorted(found, key=lambda f: (-f[2], f[3])):
        best, at = 0.3, None
        for i, t in enumerate(truth):
            if i not in taken and overlap(f[4:8], t[4:8]) >= best:
                best, at = overlap(f[4:8], t[4:8]), i
        if at is not None:
            taken.add(at)
        out[f[3]] = None if at is None else truth[at][2]
    return out


def test_truth_is_claimed_greedily(spark):
    rng = random.Random(4)
    box = lambda: (lambda x, y: (x, y, x + rng.randint(5, 40), y + rng.randint(5, 40)))(rng.randint(0, 60), rng.randint(0, 60))
    found = [("r", k, rng.choice([0.3, 0.5, 0.9]), f"{k}-{i:02d}", *box()) for k in range(30) for i in range(rng.randint(0, 9))]
    truth = [("r", k, i, f"{i:02d}", *box()) for k in range(3, 30) for i in range(rng.randint(0, 9))]
    f = spark.createDataFrame(found, "recording string, frame long, conf double, ord string, x1 int, y1 int, x2 int, y2 int")
    t = spark.createDataFrame(truth, "recording string, frame long, track long, ord string, x1 int, y1 int, x2 int, y2 int")
    got = {r["ord"]: r["landed_on"] for r in link.match_truth(f, t, ["recording", "frame"]).collect()}
    want = {}
    for k in range(30):
        want |= plain_match([x for x in found if x[1] == k], [x for x in truth if x[1] == k])
    assert got == want


def test_curve_and_floor(spark):
    j = spark.createDataFrame([("r", 0.9, "0", True), ("r", 0.8, "1", False), ("r", 0.7, "2", True)], "recording string, conf double, ord string, hit boolean")
    c = link.curve(j, spark.createDataFrame([("r", 4)], "recording string, truth_boxes long"), ["recording"])
    assert [(r["precision"], r["recall"]) for r in c.orderBy("rank").collect()] == [(1.0, 0.25), (0.5, 0.25), (2 / 3, 0.5)]
    assert tuple(link.at_precision(c, 0.6, ["recording"]).first()) == ("r", 0.5, 0.7)
    assert tuple(link.at_precision(c, 0.99, ["recording"]).first()) == ("r", 0.25, 0.9)


def test_passes_vote_once_each(spark):
    rows = [("f", 0, "a", 0.9, 0, 0, 40, 40, "0"), ("f", 1, "b", 0.6, 2, 2, 40, 40, "1"), ("f", 1, "a", 0.5, 1, 1, 20, 20, "2"), ("f", 2, "c", 0.3, 200, 200, 240, 240, "3")]
    s = spark.createDataFrame(rows, "frame string, pass_no int, taxon string, confidence double, x1 int, y1 int, x2 int, y2 int, ord string")
    got = sorted((r["label"], r["votes"], r["confidence"]) for r in link.fuse_passes(s, 3, ["frame"]).collect())
    assert got == [("a", 2, 0.5), ("c", 1, 0.1)]
    kept = link.distinct_individuals(s, ["frame"]).collect()
    assert sorted(r["ord"] for r in kept) == ["0", "2", "3"] or sorted(r["ord"] for r in kept) == ["0", "3"]


def test_crowded_moments_match_a_plain_tracker(spark):
    rng = random.Random(8)
    rows = []
    for m in range(5):
        for i in range(260):
            x, y, w, h = rng.randint(0, 160), rng.randint(0, 20) * 6, rng.randint(4, 40), rng.randint(4, 40)
            rows.append(("r", m * 0.5, rng.choice("abcd"), rng.choice([0.2, 0.5, 0.9]), x, y, x + w, y + h, f"{m}-{i:04d}"))
    assert 260 * 260 > link.Linker.CHUNK  # pairs are made by levels
    got = {r["ord"]: r["animal"] for r in link.track(spark.createDataFrame(rows, S).repartition(3)).collect()}
    assert got == plain_tracks(rows)


def test_one_crowded_moment_after_another_follows_its_rows():
    rng = np.random.default_rng(3)
    linker, began = link.Linker(1.5), time.perf_counter()
    for m in range(4):
        at, size = rng.integers(0, (4000, 3000), (8000, 2)), rng.integers(10, 60, (8000, 2))
        linker.moment(m * 0.25, np.concatenate((at, at + size), 1).astype(float), [str(t) for t in rng.integers(0, 25, 8000)])
    assert time.perf_counter() - began < 6  # pair by pair this takes far longer
