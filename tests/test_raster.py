import math

import numpy as np
import pytest

from benthos.operators import raster
from benthos.plans import planes


def plain_label(mask):
    """Flood fill in raster order."""
    out, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask)):
        if not out[y, x]:
            n += 1
            todo = [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not out[a, b]:
                    out[a, b] = n
                    todo += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
    return out, n


def test_labels_and_closing_against_plain_forms():
    rng = np.random.default_rng(1)
    for share in (0.02, 0.3, 0.5, 0.6, 0.95):
        for shape in ((1, 9), (9, 1), (13, 17), (40, 31)):
            mask = rng.random(shape) < share
            lab, n = raster.label(mask)
            want, m = plain_label(mask)
            assert n == m and (lab == want).all()
            at = lambda a, y, x: 0 <= y < shape[0] and 0 <= x < shape[1] and a[y][x]
            near = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
            grown = [[any(at(mask, y + i, x + j) for i, j in near) for x in range(shape[1])] for y in range(shape[0])]
            shut = [[all(at(grown, y + i, x + j) for i, j in near) for x in range(shape[1])] for y in range(shape[0])]
            assert (raster.closed(mask) == np.array(shut)).all()


def test_blur_mirrors_at_the_edges():
    rng = np.random.default_rng(2)
    plane, sigma = rng.random((5, 9)), 1.6
    r = int(4 * sigma + 0.5)
    w = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-r, r + 1)]
    mirror = lambda i, n: (i % (2 * n)) if (i % (2 * n)) < n else 2 * n - 1 - i % (2 * n)
    want = [[sum(w[a + r] * w[b + r] * plane[mirror(y + a, 5), mirror(x + b, 9)] for a in range(-r, r + 1) for b in range(-r, r + 1)) / sum(w) ** 2 for x in range(9)] for y in range(5)]
    assert np.allclose(raster.blur(plane, sigma), want)


def test_particles_follow_the_size_of_the_frame():
    rng = np.random.default_rng(0)
    plane = rng.normal(size=(108, 192)) * 0.01  # a tenth of the size that the rule was fitted at: one pixel is enough
    plane[10:14, 10:14] += 5
    plane[50:53, 90:94] += 5
    assert raster.particles_of(plane)[0] == 2
    wide = np.kron(plane, np.ones((5, 5)))  # half the size: 25 pixels
    wide[300:302, 300:302] += 5  # four pixels are too few
    assert raster.particles_of(wide)[0] == 2
    assert raster.particles_of(np.zeros((64, 64))) == (0, 0.0)
    assert raster.picks(10, 3).tolist() == [0, 4, 9] and raster.picks(2, 5).tolist() == [0, 1]


def scene(n=10, size=64, move=(0, 0), seed=3):
    rng = np.random.default_rng(seed)
    ground = rng.integers(0, 40, (size + 2 * n * max(1, *map(abs, move)),) * 2).astype(float)
    o = n * max(1, *map(abs, move))
    return np.stack([ground[o + k * move[0] : o + k * move[0] + size, o + k * move[1] : o + k * move[1] + size] for k in range(n)])


@pytest.mark.parametrize("move", [(0, 0), (1, -2)])
def test_an_animal_is_found_whether_or_not_the_camera_moves(move):
    frames = scene(move=move).copy()
    for k in range(10):
        frames[k, 28:36, 12 + 4 * k : 20 + 4 * k] = 200.0
    m = raster.movers_of(frames, seconds=3.0)
    assert m.objects == 1 and 0.01 < m.area < 0.05
    assert abs(m.speed - math.hypot(*move) * 9 / 3.0) < 1e-6
    left, top, right, bottom = m.box
    assert right - left in range(6, 10) and bottom - top in range(6, 10)


def test_the_busiest_window_counts_and_quiet_ones_do_not_dilute():
    frames = np.concatenate([scene(10), scene(10), scene(7)]).copy()
    for k in range(10):
        frames[10 + k, 20:30, 5 + 4 * k : 15 + 4 * k] = 220.0
    alone = raster.movers_of(frames[10:20])
    assert raster.movers_of(frames)[1:] == alone[1:] and alone.objects == 1


def test_what_is_refused():
    rng = np.random.default_rng(5)
    still = scene()
    assert raster.movers_of(still)[1:] == (0.0, 0.0, None)
    assert math.isnan(raster.movers_of(still[:3]).speed) and math.isnan(raster.movers_of(still[:, :31]).speed)
    one_pixel = still.copy()
    one_pixel[5, 30, 30] = 255
    assert raster.movers_of(one_pixel).objects == 0  # too small
    whole = still.copy()
    whole[5, 4:-4, 4:-4] += 60
    assert raster.movers_of(whole).objects == 0  # the scene shifted
    assert raster.movers_of(rng.random((10, 64, 64)) * 255).objects == 0  # nothing lines up
    assert raster.steadied(scene(move=(7, 0), size=64)) is None  # too little is left
    ground = rng.integers(0, 40, (200, 200)).astype(float)
    assert raster.steadied(np.stack([np.roll(ground, (14 * k, 0), (0, 1)) for k in range(10)])) is None  # over the limit


def test_shifts():
    still = np.random.default_rng(1).random((32, 40))
    moves = [(0, 0), (3, -2), (-5, 7), (15, 19)]
    got = raster.shifts_to(np.stack([np.roll(still, m, (0, 1)) for m in moves]), still)
    assert got.tolist() == [list(m) for m in moves]


def test_colours():
    red = raster.spread_of(np.tile([1.0, 0.0, 0.0], (1, 50, 1)))
    assert red.hues[0] == 1 and red.saturations[-1] == 1 and red.colourful == 1 and abs(red.colourfulness - 0.3 * math.hypot(255, 127.5)) < 1e-9
    assert raster.spread_of(np.zeros((2, 9, 3))) is None
    grey = raster.spread_of(np.full((1, 9, 3), 0.5))
    assert sum(grey.hues) == 0 and grey.saturations[0] == 1 and grey.saturation_mean == 0
    pale = np.array([[[0.5, 0.46, 0.46]] * 3 + [[0.0, 0.0, 1.0]]])  # 0.08 of saturation has no hue that counts
    assert raster.spread_of(pale).hues[8] == 1
    two = raster.spread_of(np.stack([np.tile([1.0, 0.0, 0.0], (4, 1)), np.tile([0.0, 0.0, 0.0], (4, 1))]))
    assert two.colourful == 1 and two.colourfulness == red.colourfulness  # the dark frame is left out


def test_rows_without_a_plane(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [1.0, 2.0]), (4, [0.5] * 16)], "id long, v array<double>").selectExpr("*", "1 as particles")
    assert [r["id"] for r in raster.colour_spread(df, "id", "v", 4).collect()] == [4]
    assert [r["id"] for r in raster.bright_particles(df, "id", "v", (4, 4)).collect()] == [4]
    assert {r["id"]: r["camera_speed"] is None or math.isnan(r["camera_speed"]) for r in raster.moving_objects(df, "id", "v", (2, 2)).collect()} == {3: True, 4: True}
    assert [r["plane"] for r in raster.thumbnails(df, "id", "v", (4, 4)).orderBy("id").collect()] == [None] * 4
    assert raster.colour_spread(df.limit(0), "id", "v", 4).count() == 0
    whole = spark.createDataFrame([(1, [255, 0, 0] * 4)], "id long, v array<int>")
    assert raster.colour_spread(whole, "id", "v", 3).first()["hues"][0] == 1


def test_stacks_are_dealt_out_and_drawn_by_rule(spark, tmp_path):
    keys = [*range(70), 10_006, -4, None]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    d = planes._stack(spark, str(tmp_path))
    assert d.rdd.getNumPartitions() > 1
    rem = math.fmod
    for r in d.collect():
        k, v = r["s_suppkey"], r["frames"]
        assert len(v) == 23040
        for i in range(0, 23040, 7):
            f, y, x = i // 2304, i % 2304 // 48, i % 48
            if k is None:
                assert v[i] is None
                continue
            inside = rem(k, 5) != 0 and 0 <= x - (rem(k, 10) + f * 3) <= 4 + rem(k, 3) and 2 <= y - rem(k, 30) <= 7
            assert v[i] == rem(x * x * 31 + y * y * 17 + x * y * 7 + k * 13, 97) + (100 if inside else 0)
    assert planes.moving_objects(spark, str(tmp_path)).count() == len(keys)
