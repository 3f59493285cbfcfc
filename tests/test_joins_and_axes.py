import bisect
import random

from pyspark.sql import functions as F

from benthos.functions import exprs
from benthos.operators import analytics, hierarchy, joins, selection


def test_asof_nearest_takes_the_earlier_of_two(spark):
    rng = random.Random(1)
    left = [(i, rng.choice("ab"), float(rng.randint(0, 400))) for i in range(200)]
    right = [(k, float(t), f"{k}{t}") for k in "ab" for t in sorted(rng.sample(range(0, 400, 7), 30))]
    out = joins.asof_nearest(spark.createDataFrame(left, "id long, k string, at double"), spark.createDataFrame(right, "k string, at double, fix string"), "k", "at", 20.0, ["fix"])
    got = {r["id"]: r["fix"] for r in out.collect()}
    for i, k, t in left:
        times = [x for kk, x, _ in right if kk == k]
        at = min(bisect.bisect_left(times, t), len(times) - 1)
        best = min((max(0, at - 1), at), key=lambda j: abs(times[j] - t))
        want = f"{k}{int(times[best])}" if abs(times[best] - t) <= 20 else None
        assert got[i] == want


def test_prefix_needs_a_separator_unless_loose(spark):
    names = spark.createDataFrame([("dive_1_a",), ("dive",), ("divers",), ("other",)], "name string")
    stems = spark.createDataFrame([("dive",), ("dive_1",)], "stem string")
    get = lambda strict: {r["name"]: r["stem"] for r in joins.longest_prefix(names, stems, "name", "stem", strict).collect()}
    assert get(True) == {"dive_1_a": "dive_1", "dive": "dive", "divers": None, "other": None}
    assert get(False)["divers"] == "dive"


def test_interval_first_and_open_end(spark):
    left = spark.createDataFrame([(1, 5), (2, 50), (3, 0)], "id long, at long")
    right = spark.createDataFrame([(1, 4, 10), (2, 3, None), (3, 40, 60)], "no long, start long, stop long")
    got = {r["id"]: r["no"] for r in joins.interval_first(left, right, "at", "start", "stop", ["no"], ["id"]).collect()}
    assert got == {1: 1, 2: 2, 3: None}


def test_interval_first_against_every_pair(spark):
    rng = random.Random(5)
    some = lambda v: rng.choice([v, v, v, v, None])
    left = [(i, some(rng.choice("abc")), some(rng.randint(0, 40))) for i in range(400)] + [(7, "b", 9), (None, "a", 3), (None, "c", 30)]
    right = [(some(rng.randint(0, 9)), some(rng.choice("abd")), some(s := rng.randint(0, 40)), some(s + rng.randint(-3, 12)), i) for i in range(60)]
    a = spark.createDataFrame(left, "id long, k string, at long").repartition(3)
    b = spark.createDataFrame(right, "no long, k string, start long, stop long, i long")

    def first(keys, use):
        hits = [(r[0] is None, r[0] or 0, r[2], r[3] is not None, r[3] or 0, r[4]) for _, k, at in keys for r in right if at is not None and r[2] is not None and (not use or (k is not None and k == r[1])) and r[2] <= at and (r[3] is None or at <= r[3])]
        return min(hits)[-1] if hits else None

    for on in (["k"], None):
        right_of = b if on else b.drop("k")
        got = [(r["id"], r["i"]) for r in joins.interval_first(a, right_of, "at", "start", "stop", ["no"], ["id"], on).collect()]
        ids = {x[0] for x in left}
        assert len(got) == len(ids) and dict(got) == {i: first([x for x in left if x[0] == i], on) for i in ids}


def test_interval_first_of_dates_and_far_ends(spark):
    a = spark.sql("select 1L as id, date'2020-01-02' as at union all select 2L, date'2031-01-01'")
    b = spark.sql("select 'x' as no, timestamp_ntz'2020-01-02 00:00:00' as start, timestamp_ntz'9999-12-31 00:00:00' as stop union all select 'a', timestamp_ntz'2030-01-01 00:00:00', null")
    got = joins.interval_first(a, b, "at", "start", "stop", ["no"], ["id"]).select("id", "no").collect()
    assert {r["id"]: r["no"] for r in got} == {1: "x", 2: "a"}


def test_spread_and_bottom(spark):
    items = spark.createDataFrame([(f"{i:03d}", 1) for i in range(100)], "url string, dive int")
    picked = sorted(r["url"] for r in selection.spread(items, 5, ["dive"], ["url"]).collect())
    assert picked == ["000", "020", "040", "060", "080"] and selection.spread(items, 0, ["dive"], ["url"]).count() == 100
    v = spark.createDataFrame([(1, "a", 5), (1, "b", 50), (2, "c", 5), (3, "d", None)], "dive int, url string, recorded_at long")
    w = spark.createDataFrame([(1, 40, 60), (2, 90, 99), (3, 1, 2)], "dive int, start long, stop long")
    assert sorted(r["url"] for r in selection.on_the_bottom(v, w).collect()) == ["b", "c", "d"]


def test_longitudes_around_the_dateline(spark):
    p = spark.createDataFrame([("g", 10.0, x) for x in (-166.67, 179.87, -178.50)], "grp string, latitude double, longitude double")
    r = analytics.placed(p, ["grp"]).first()
    assert (r["west"], r["east"]) == (179.87, -166.67) and abs(r["width"] - 13.46) < 1e-6
    assert abs(r["mean_longitude"]) > 170


def test_names_as_text(spark):
    df = spark.createDataFrame([("EX_DIVE02_20210731T123456Z.mp4", "28°, 15.064' N ; 79°, 36.072' W", "Funiculina-Balticina complex"), ("x_20219931T123456Z", "12.5 ; -3.25", "Keratoisis sp."), ("none", "N/A ; N/A", "fish")], "n string, p string, c string")
    got = df.select(exprs.recorded_at(F.col("n")).cast("string").alias("at"), exprs.dive_number(F.col("n")).alias("dive"), exprs.position(F.col("p")).alias("pos"), exprs.candidates(F.col("c")).alias("c"), exprs.slug(F.col("c")).alias("slug")).collect()
    assert [r["at"] for r in got] == ["2021-07-31 12:34:56", None, None] and [r["dive"] for r in got] == [2, None, None]
    assert abs(got[0]["pos"]["latitude"] - (28 + 15.064 / 60)) < 1e-9 and got[0]["pos"]["longitude"] < -79 and tuple(got[1]["pos"]) == (12.5, -3.25) and got[2]["pos"] is None
    assert got[0]["c"] == ["Funiculina-Balticina complex", "Funiculina-Balticina", "Funiculina"] and got[1]["c"] == ["Keratoisis sp.", "Keratoisis"]
    assert got[1]["slug"] == "keratoisis-sp"


def test_nearest_rank(spark):
    f = lambda v, p: spark.range(1).select(exprs.nearest_rank(F.array(*[F.lit(float(x)) for x in v]).cast("array<double>"), p)).first()[0]
    assert f([1, 2, 3, 4], 0.5) == 3 and f([], 0.5) == 0.0 and f([5], 0.9) == 5


def test_shared_prefix(spark):
    f = lambda rows: spark.createDataFrame([(rows,)], "l array<array<string>>").select(exprs.shared_prefix(F.col("l"))).first()[0]
    assert f([["a", "b", "c"], ["a", "b", "d"]]) == ["a", "b"] and f([["a"], ["b"]]) == [] and f([["a", "b"]]) == ["a", "b"]


def test_unique_slugs(spark):
    n = spark.createDataFrame([("A b",), ("a-b",), ("A  B",), ("???",)], "name string")
    assert sorted(r["file"] for r in hierarchy.unique_slugs(n, exprs.slug(F.col("name")), []).collect()) == ["a-b", "a-b-2", "a-b-3", "unnamed"]


def test_composition_folds_what_is_small(spark):
    rows = [("b1", f"k{i}", float(20 - i)) for i in range(12)] + [("b2", "k0", 1.0)]
    got = {(r["bucket"], r["band"]): r["animals"] for r in analytics.composition(spark.createDataFrame(rows, "bucket string, band string, animals double")).collect()}
    assert got["b1", "3 more"] == 11 + 10 + 9 and got["b2", "k0"] == 1 and len(got) == 11
