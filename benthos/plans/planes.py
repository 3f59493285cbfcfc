"""Queries over numeric planes: colour, particles, movement, thumbnails."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from benthos.operators import raster

from .adapt import read
from .registry import query

# --- 64 floats as four frames of 16, or as 16 pixels of four channels --------------------------


@query("""SELECT vec_id, round(list_avg(d), 5) AS mean_difference, round(list_max(d), 5) AS max_difference FROM (SELECT vec_id, list_transform(range(1, 4), lambda f: list_avg(list_transform(range(1, 17), lambda i: abs(embedding[f*16 + i]::DOUBLE - embedding[(f-1)*16 + i]::DOUBLE)))) AS d FROM embeddings)""")
def frame_differences(spark, sf_dir):
    d = raster.frame_differences(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 4, 16)
    return d.select("vec_id", F.round("mean_difference", 5).alias("mean_difference"), F.round("max_difference", 5).alias("max_difference"))


@query("SELECT vec_id, round(list_avg(list_transform(range(0, 16), lambda i: embedding[i*4+1]::DOUBLE)), 5) AS red, round(list_avg(list_transform(range(0, 16), lambda i: embedding[i*4+2]::DOUBLE)), 5) AS green, round(list_avg(list_transform(range(0, 16), lambda i: embedding[i*4+3]::DOUBLE)), 5) AS blue FROM embeddings")
def channel_means(spark, sf_dir):
    d = raster.channel_means(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 4)
    return d.select("vec_id", *[F.round(c, 5).alias(c) for c in ("red", "green", "blue")])


_PIX = """px AS (SELECT vec_id, unnest(range(0, 16)) AS i, embedding FROM embeddings), raw AS (SELECT vec_id, embedding[i*4+1]::DOUBLE AS r, embedding[i*4+2]::DOUBLE AS g, embedding[i*4+3]::DOUBLE AS b FROM px),
rgb AS (SELECT vec_id, r / p AS r, g / p AS g, b / p AS b FROM (SELECT *, greatest(1.0::DOUBLE, max(greatest(r, g, b)) OVER (PARTITION BY vec_id)) AS p FROM raw))"""
_COLOURFUL = "255 * (sqrt(var_pop(r-g) + var_pop((r+g)/2-b)) + 0.3::DOUBLE*sqrt(pow(avg(r-g),2) + pow(avg((r+g)/2-b),2)))"


@query(f"WITH {_PIX} SELECT vec_id, round({_COLOURFUL}, 4) AS colourfulness FROM rgb GROUP BY vec_id")
def colourfulness(spark, sf_dir):
    d = raster.colourfulness(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 4)
    return d.select("vec_id", F.round("colourfulness", 4).alias("colourfulness"))


_HUES = ", ".join(f"round(coalesce(sum(s) FILTER (WHERE strong AND hue = {k}) / nullif(sum(s) FILTER (WHERE strong), 0), 0), 5) AS hue_{k:02d}" for k in range(12))
_SATS = ", ".join(f"round(count(*) FILTER (WHERE sat = {k}) / count(*)::DOUBLE, 5) AS saturation_{k:02d}" for k in range(8))


@query(f"""WITH {_PIX}, scores AS (SELECT vec_id, {_COLOURFUL} AS colourfulness FROM rgb GROUP BY vec_id),
spans AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS c FROM rgb),
hsv AS (SELECT vec_id, v, CASE WHEN v > 0 THEN c / greatest(v, 1e-6::DOUBLE) ELSE 0 END AS s, CASE WHEN c <= 0 THEN 0 WHEN v = r THEN ((g - b) / greatest(c, 1e-6::DOUBLE) + CASE WHEN g < b THEN 6 ELSE 0 END) WHEN v = g THEN (b - r) / greatest(c, 1e-6::DOUBLE) + 2 ELSE (r - g) / greatest(c, 1e-6::DOUBLE) + 4 END / 6 AS h FROM spans),
lit AS (SELECT vec_id, s, s >= 0.12::DOUBLE AS strong, least(11, CAST(floor(h * 12) AS INT)) AS hue, least(7, CAST(floor(s * 8) AS INT)) AS sat FROM hsv WHERE v >= 0.08::DOUBLE)
SELECT vec_id, round(any_value(colourfulness), 4) AS colourfulness, round(avg(s), 5) AS saturation_mean, round(count(*) FILTER (WHERE sat >= 1) / count(*)::DOUBLE, 5) AS colourful, {_HUES}, {_SATS} FROM lit JOIN scores USING (vec_id) GROUP BY vec_id""")
def colour_spread(spark, sf_dir):
    d = raster.colour_spread(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 4)
    hues = [F.round(F.get("hues", k), 5).alias(f"hue_{k:02d}") for k in range(raster.HUES)]
    sats = [F.round(F.get("saturations", k), 5).alias(f"saturation_{k:02d}") for k in range(raster.SATURATIONS)]
    return d.select("vec_id", F.round("colourfulness", 4).alias("colourfulness"), F.round("saturation_mean", 5).alias("saturation_mean"), F.round("colourful", 5).alias("colourful"), *hues, *sats)


# --- planes drawn by rule, one stack for each supplier -----------------------------------------

SIDE, FRAMES, BAND = 32, 10, 48
#: Stacks that are drawn at once; one has 45 KB.
DRAWN = 64


def _plane(spark, sf_dir):
    """32 x 32: a faint texture with one to four bright squares."""
    k = F.col("s_suppkey").cast("int")
    y, x = (lambda i: F.floor(i / SIDE).cast("int")), (lambda i: (i % SIDE).cast("int"))
    near = lambda i, b: (F.abs(x(i) - ((k * 37 + b * 11) % 24 + 4)) <= 1) & (F.abs(y(i) - ((k * 53 + b * 17) % 24 + 4)) <= 1)
    lamps = lambda i: sum((F.when((F.lit(b) <= k % 4) & near(i, b), 120).otherwise(0) for b in range(1, 4)), F.when(near(i, 0), 120).otherwise(0))
    value = lambda i: (F.lit(20) + (x(i) * 7 + y(i) * 13 + k) % 5 + lamps(i)).cast("double")
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), value).alias("plane"))


_LAMPS = " + ".join(f"CASE WHEN {b} <= k % 4 AND abs(x - ((k*37 + {b * 11}) % 24 + 4)) <= 1 AND abs(y - ((k*53 + {b * 17}) % 24 + 4)) <= 1 THEN 120 ELSE 0 END" for b in range(4))
_PLANE = f"""grid AS (SELECT s_suppkey AS k, CAST(p // 32 AS INT) AS y, CAST(p % 32 AS INT) AS x FROM supplier, range(0, 1024) AS t(p)),
plane AS (SELECT k, y, x, CAST(20 + (x*7 + y*13 + k) % 5 + {_LAMPS} AS DOUBLE) AS v FROM grid)"""


def _regions(mask: str, name: str) -> str:
    """Four-connected regions of a table (k, y, x) as (k, y, x, first): each pixel with the first pixel of its region."""
    return f"""{name}_reach AS (SELECT k, y, x, y AS ty, x AS tx FROM {mask}
  UNION SELECT r.k, r.y, r.x, m.y, m.x FROM {name}_reach r JOIN {mask} m ON m.k = r.k AND abs(m.y - r.ty) + abs(m.x - r.tx) = 1),
{name} AS (SELECT k, y, x, min(ty * 1000 + tx) AS first FROM {name}_reach GROUP BY k, y, x)"""


def _blurred(name: str, sigma: float) -> str:
    """Two passes of a Gaussian over `plane`, mirrored at the edges."""
    r = int(4 * sigma + 0.5)
    mirror = lambda c: f"CASE WHEN {c} < 0 THEN -1 - ({c}) WHEN {c} > 31 THEN 63 - ({c}) ELSE {c} END"
    w = f"exp(-0.5::DOUBLE * (d / {sigma}::DOUBLE) * (d / {sigma}::DOUBLE))"
    return f"""{name}_w AS (SELECT d, {w} / sum({w}) OVER () AS w FROM range({-r}, {r + 1}) AS t(d)),
{name}_y AS (SELECT g.k, g.y, g.x, sum(w * v) AS v FROM grid g, {name}_w JOIN plane p ON p.k = g.k AND p.x = g.x AND p.y = {mirror("g.y + d")} GROUP BY g.k, g.y, g.x),
{name} AS (SELECT g.k, g.y, g.x, sum(w * v) AS v FROM grid g, {name}_w JOIN {name}_y p ON p.k = g.k AND p.y = g.y AND p.x = {mirror("g.x + d")} GROUP BY g.k, g.y, g.x)"""


@query(f"""WITH RECURSIVE {_PLANE}, {_blurred("narrow", 0.8)}, {_blurred("wide", 1.6)},
band AS (SELECT n.k, n.y, n.x, n.v - w.v AS v FROM narrow n JOIN wide w USING (k, y, x)), mid AS (SELECT k, median(v) AS m FROM band GROUP BY k),
dev AS (SELECT k, m, coalesce(nullif(median(abs(v - m)), 0), 1) AS d FROM band JOIN mid USING (k) GROUP BY k, m), mask AS (SELECT k, y, x FROM band JOIN dev USING (k) WHERE v > m + 5 * 1.4826::DOUBLE * d),
{_regions("mask", "lab")}, areas AS (SELECT k, first, count(*) AS n FROM lab GROUP BY k, first)
SELECT s_suppkey, coalesce(count(first), 0)::DOUBLE AS particles, round(coalesce(sum(n), 0) / 1024::DOUBLE, 6) AS area FROM supplier LEFT JOIN areas ON k = s_suppkey GROUP BY 1""")
def bright_particles(spark, sf_dir):
    d = raster.bright_particles(_plane(spark, sf_dir), "s_suppkey", "plane", (SIDE, SIDE))
    return d.select("s_suppkey", "particles", F.round("area", 6).alias("area"))


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys with their frames, DRAWN at a time; a null key has frames of nulls. Remainders have the sign of SQL's."""
    size = BAND * BAND
    f, y, x = (a.ravel() for a in np.indices((FRAMES, BAND, BAND)))
    base, ends = x * x * 31 + y * y * 17 + x * y * 7, np.arange(DRAWN + 1, dtype=np.int32) * FRAMES * size
    for b in batches:
        for at in range(0, b.num_rows, DRAWN):
            some = b.slice(at, DRAWN)
            key = some.column(0).cast(pa.int64())
            k = key.fill_null(0).to_numpy(zero_copy_only=False)[:, None]
            left, top = x - (np.fmod(k, 10) + f * 3), y - np.fmod(k, 30)
            inside = (left >= 0) & (left <= 4 + np.fmod(k, 3)) & (top >= 2) & (top <= 7) & (np.fmod(k, 5) != 0)
            values = (np.fmod(base + k * 13, 97) + 100 * inside).astype(np.int16).ravel()
            gone = np.repeat(key.is_null().to_numpy(zero_copy_only=False), FRAMES * size)
            frames = pa.ListArray.from_arrays(pa.array(ends[: len(some) + 1]), pa.array(values, mask=gone if gone.any() else None))
            yield pa.RecordBatch.from_arrays([some.column(0), frames], ["s_suppkey", "frames"])


def _stack(spark, sf_dir):
    """Ten frames of 48 x 48: one texture for all, and a square that crosses it.

    A key is a few bytes and its frames take milliseconds, so keys are dealt out before anything is drawn.
    """
    keys = read(spark, sf_dir, "supplier").select("s_suppkey")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return keys.repartition(tasks).mapInArrow(_drawn, f"s_suppkey {keys.schema['s_suppkey'].dataType.simpleString()}, frames array<smallint>")


@query(f"""WITH RECURSIVE px AS (SELECT s_suppkey AS k, CAST(p // 2304 AS INT) AS f, CAST(p % 2304 // 48 AS INT) AS y, CAST(p % 48 AS INT) AS x FROM supplier, range(0, 23040) AS t(p)),
cut AS (SELECT k, f, y - 1 AS y, x - 1 AS x, (x*x*31 + y*y*17 + x*y*7 + k*13) % 97 + CASE WHEN k % 5 <> 0 AND x - (k % 10 + f*3) BETWEEN 0 AND 4 + k % 3 AND y - k % 30 BETWEEN 2 AND 7 THEN 100 ELSE 0 END AS v FROM px WHERE y BETWEEN 1 AND 46 AND x BETWEEN 1 AND 46),
back AS (SELECT k, y, x, median(v) AS b FROM cut GROUP BY k, y, x), off AS (SELECT k, f, y, x, abs(v - b) AS d FROM cut JOIN back USING (k, y, x)), noise AS (SELECT k, y, x, median(d) AS n FROM off GROUP BY k, y, x),
calm AS (SELECT k FROM off WHERE f = 5 GROUP BY k HAVING median(d) <= 8), mask AS (SELECT k, y, x FROM off JOIN noise USING (k, y, x) JOIN calm USING (k) WHERE f = 5 AND d > greatest(14, 5 * n)),
grown AS (SELECT DISTINCT k, y + dy AS y, x + dx AS x FROM mask, range(-2, 3) AS a(dy), range(-2, 3) AS b(dx) WHERE y + dy BETWEEN 0 AND 45 AND x + dx BETWEEN 0 AND 45),
closed AS (SELECT k, y, x FROM (SELECT k, y + dy AS y, x + dx AS x FROM grown, range(-2, 3) AS a(dy), range(-2, 3) AS b(dx)) GROUP BY k, y, x HAVING count(*) = 25),
{_regions("closed", "lab")}, areas AS (SELECT k, first, count(*) AS n, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM lab GROUP BY k, first HAVING count(*) >= 16),
best AS (SELECT k, count(*) AS objects, arg_max(struct_pack(n, x0, y0, x1, y1), n * 100000 - first) AS b FROM areas GROUP BY k HAVING max(n) / 2116::DOUBLE <= 0.35::DOUBLE)
SELECT s_suppkey, 0.0::DOUBLE AS camera_speed, coalesce(objects, 0)::DOUBLE AS objects, round(coalesce(b.n, 0) / 2116::DOUBLE, 6) AS area, b.x0 AS x0, b.y0 AS y0, b.x1 AS x1, b.y1 AS y1 FROM supplier LEFT JOIN best ON k = s_suppkey""")
def moving_objects(spark, sf_dir):
    """The camera stands still, so the twin knows the shift; everything after the alignment is restated."""
    d = raster.moving_objects(_stack(spark, sf_dir), "s_suppkey", "frames", (BAND, BAND))
    return d.select("s_suppkey", "camera_speed", "objects", F.round("area", 6).alias("area"), *[F.get("box", i).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])


@query("""WITH f AS (SELECT p_partkey, CAST(i AS INT) AS i, CAST((p_partkey * 7 + i * i) % 211 AS DOUBLE) AS v FROM part, range(0, 240) AS t(i)), top AS (SELECT p_partkey, max(v) AS m FROM f WHERE i BETWEEN 120 AND 239 GROUP BY 1)
SELECT p_partkey, list(CAST(floor(v / CASE WHEN m <> 0 THEN m ELSE 1 END * 255) AS INT) ORDER BY j) AS plane FROM (SELECT j, 120 + (j // 8) * 10 // 7 * 12 + (j % 8) * 12 // 8 AS i FROM range(0, 56) AS t(j)) JOIN f USING (i) JOIN top USING (p_partkey) GROUP BY 1""")
def thumbnails(spark, sf_dir):
    """Two frames of 10 x 12 for each part; the later one, at most 8 wide."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(k, F.transform(F.sequence(F.lit(0), F.lit(239)), lambda i: ((k * 7 + i * i) % 211).cast("double")).alias("frames"))
    return raster.thumbnails(p, "p_partkey", "frames", (10, 12), 8).select("p_partkey", "plane")
