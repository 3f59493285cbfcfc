"""What an event, a tile or a moment shows: stills, frames, clips, boxes between looks, captions, colours."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benthos.functions.exprs import clock, nearest_rank

#: Fixed: the frame of an expedition that says none.
FRAME = (16, 9)
# Fixed values of the gallery.
STILLS, SLICES, A_LOOK, A_STRIDE, SHARE = 6, 400, 0.7, 2.5, 0.06


def event_step(e: str = "") -> Column:
    c = lambda n: F.col(f"{e}{n}")
    return F.when(c("slices") > 1, F.greatest(F.floor((c("to_t") - c("from_t")) / (c("slices") - 1) + 0.5), F.lit(1))).otherwise(1).cast("bigint")


def still_times(events: DataFrame, most: int = STILLS) -> DataFrame:
    """events exploded to the slice times to preview: all of a short event, evenly stepped in a long one."""
    step = F.greatest(F.lit(1), F.floor(F.col("slices") / most + 0.5)).cast("bigint")
    at = F.slice(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1, step), lambda i: F.col("from_t") + i * event_step()), 1, most)
    return events.withColumn("t", F.explode(at))


def slice_range(events: DataFrame, most: int = SLICES) -> DataFrame:
    """events exploded to every slice time they cover, at most `most` (the page's own limit)."""
    return events.withColumn("t", F.explode(F.slice(F.sequence(F.col("from_t"), F.col("to_t"), event_step()), 1, most)))


def stills(times: DataFrame, slices: DataFrame) -> DataFrame:
    """times (name, t) with the crop or else the thumbnail of that slice."""
    pics = slices.select(F.col("name").alias("_n"), F.col("dim_t").alias("_t"), F.coalesce("detection_crop", "slice_thumbnail").alias("picture"))
    return times.join(pics, (F.col("name") == F.col("_n")) & (F.col("t") == F.col("_t")), "left").drop("_n", "_t")


def strided(rows: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """Every k-th row of each group in order, k = max(1, n // most), at most `most` of them."""
    w = Window.partitionBy(*by)
    x = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_k", F.greatest(F.lit(1), F.floor(F.count("*").over(w) / most)))
    return x.where((F.col("_i") % F.col("_k") == 0) & (F.col("_i") / F.col("_k") < most)).drop("_i", "_k")


def to_play(frames: DataFrame, by: list[str]) -> DataFrame:
    """All frames of a group that is one clip (two or more, all clip frames); else its best picture only."""
    w = Window.partitionBy(*by)
    steady = (F.count("*").over(w) > 1) & (F.min(F.col("clip").cast("int")).over(w) == 1)
    best = F.row_number().over(w.orderBy(F.desc(F.coalesce("conf", F.lit(0.0))), "ord"))
    return frames.withColumn("_s", steady).withColumn("_b", best).where("_s or _b = 1").drop("_s", "_b")


def box_at(looks: DataFrame, moments: DataFrame, key: str) -> DataFrame:
    """moments (key, now) with the box there: interpolated between looks that are close, held A_LOOK around others.

    looks: (key, second, x1..y2). One union and two running windows.
    """
    look = F.struct("second", "x1", "y1", "x2", "y2")
    none = F.lit(None)
    both = moments.select(key, F.col("now").alias("_w"), F.lit(1).alias("_m"), none.alias("_l")).unionByName(looks.select(key, F.col("second").alias("_w"), F.lit(0).alias("_m"), look.alias("_l")), allowMissingColumns=True)
    so_far = lambda *order: F.last("_l", ignorenulls=True).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = both.withColumn("_b", so_far("_w", F.desc("_m"))).withColumn("_a", so_far(F.desc("_w"), "_m")).where("_m = 1")  # a look at the very moment comes after it
    now, b, a = F.col("_w"), F.col("_b"), F.col("_a")
    span = a["second"] - b["second"]
    part = F.when(span > 0, (now - b["second"]) / span).otherwise(0.0)
    out = []
    for c in ("x1", "y1", "x2", "y2"):
        mid = F.when(span > A_STRIDE, F.when(now - b["second"] <= A_LOOK, b[c]).when(a["second"] - now <= A_LOOK, a[c])).otherwise(b[c] + (a[c] - b[c]) * part)
        v = F.when(a.isNull(), F.when(now <= b["second"] + A_LOOK, b[c])).when(b.isNull(), F.when(now >= a["second"] - A_LOOK, a[c])).otherwise(mid)
        out.append(v.cast("double").alias(c))
    return x.select(key, now.alias("now"), *out)


def found_again(shares: DataFrame, reels: DataFrame) -> DataFrame:
    """shares (recording, second, taxon) with the reel entry within SHARE seconds, of the same taxon if there is one, first in order."""
    from benthos.operators.joins import band

    x = band(shares, reels.select("recording", "second", "taxon", "ord"), ["recording"], "second", SHARE)
    best = F.min(F.struct((F.col("taxon") != F.col("r_taxon")).alias("d"), F.col("r_ord").alias("ord")))
    return x.groupBy(*shares.columns).agg(best["ord"].alias("found"))


def where_from(animals: DataFrame, videos: DataFrame, frames: DataFrame, terms: DataFrame) -> DataFrame:
    """animals (expedition, recording, ...) with url, frame, credit and licence: the archive's file of their recording, the
    frame that its boxes are measured in (FRAME if unknown), and the terms of its expedition (empty if none).

    videos: (expedition, stem, url), the longest stem that a recording starts with; frames: (expedition, frame); terms:
    (expedition, credit, licence).
    """
    from benthos.operators.joins import longest_prefix, lookup

    name = F.concat_ws("/", "expedition", "recording")
    stems = videos.groupBy(F.concat_ws("/", "expedition", "stem").alias("_stem")).agg(F.min("url").alias("url"))
    urls = longest_prefix(animals.select(name.alias("_name")).distinct(), stems.withColumnRenamed("_stem", "_s"), "_name", "_s").select("_name", "url")
    x = animals.withColumn("_name", name).join(urls, "_name", "left").drop("_name")
    x = x.join(frames, "expedition", "left").withColumn("frame", F.coalesce("frame", F.array(*map(F.lit, FRAME))))
    return lookup(x, terms, "expedition", {"credit": "", "licence": "", "url": ""})


def interleaved(pages: DataFrame) -> DataFrame:
    """pages (taxon, pages, pos) -> (taxon, page, n): page 0 of every taxon, then page 1 ...

    A page number's rows are counted first, so the only window over everything has a row for each number.
    """
    x = pages.where("pages > 0").withColumn("page", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1)))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = x.groupBy("page").agg(F.count("*").alias("rows")).select(F.col("page").alias("_p"), before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("page").orderBy("pos", "taxon")) - 1
    return x.withColumn("_w", within).join(sizes, F.col("page") == F.col("_p")).select("taxon", "page", (F.col("_before") + F.col("_w")).alias("n"))


def moments_to_read(available: Column, fps: Column, every: float = 1.0, burst: int = 1) -> Column:
    """Frame offsets to look at in a slice: one each `every` seconds in the middle of its stretch, or a centred burst."""
    wanted = F.greatest(F.lit(1), F.bround(available / fps / every, 0).cast("int"))
    take = F.greatest(F.lit(1), F.least(F.lit(burst), available))
    start = F.greatest(F.lit(0), F.floor((available - take) / 2).cast("int"))
    step = available / wanted
    spread = F.array_distinct(F.transform(F.sequence(F.lit(0), wanted - 1), lambda i: F.least(available - 1, F.floor((i + 0.5) * step).cast("int"))))
    few = F.sequence(start, start + take - 1)
    return F.when(available <= 0, F.array().cast("array<int>")).when(fps.isNull() | (fps <= 0) | (wanted <= 1), few).otherwise(spread)


def crop_window(box: list[Column], width: int, height: int, margin: float = 0.6) -> Column:
    """A box with room around it, inside the frame."""
    px, py = ((box[2] - box[0]) * margin).cast("int") + 8, ((box[3] - box[1]) * margin).cast("int") + 8
    return F.array(F.greatest(F.lit(0), box[0] - px), F.greatest(F.lit(0), box[1] - py), F.least(F.lit(width), box[2] + px), F.least(F.lit(height), box[3] + py))


def looks(sightings: DataFrame) -> DataFrame:
    """(recording, animal, looks): [second to one place, box] of every look, in order."""
    one = F.array(F.bround("second", 1), *[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")])
    return sightings.groupBy("recording", "animal").agg(F.transform(F.sort_array(F.collect_list(F.struct("second", "ord", one.alias("l")))), lambda s: s["l"]).alias("looks"))


def caption(taxon: Column, where: Column, second: Column, conf: Column, frames: Column, agreement: Column) -> Column:
    """The line under a tile."""
    return F.concat(F.lit("Detector guess: "), taxon, F.lit(" · "), where, F.lit(" · "), clock(second), F.lit(" · "), F.floor(conf * 100 + 0.5).cast("string"), F.lit("% certainty · "), frames.cast("string"), F.lit(" frame"), F.when(frames == 1, "").otherwise("s"), F.when(agreement < 1, F.concat(F.lit(" · agreed "), F.floor(agreement * 100 + 0.5).cast("string"), F.lit("%"))).otherwise(""))


def held(seconds: Column) -> Column:
    return F.when(seconds >= 0.05, F.concat(F.format_string("%.1f", seconds), F.lit("s"))).otherwise("·")


def scaled(r: Column, g: Column, b: Column) -> Column:
    """Channel means as 8-bit, by the range that the largest of them shows."""
    top = F.greatest(*[F.coalesce(c, F.lit(0.0)) for c in (r, g, b)])
    full = F.when(top <= 1.001, 1.0).when(top <= 255, 255.0).when(top <= 1023, 1023.0).otherwise(65535.0)
    return F.array(*[F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.floor(255.0 * F.coalesce(c, F.lit(0.0)) / full + 0.5))) for c in (r, g, b)])


def stretched(rows: DataFrame, by: str, colour: str = "rgb") -> DataFrame:
    """rows with `shown`: colours spread between the recording's 2nd and 98th percentile of brightness, their tint tripled."""
    c = lambda i: F.get(F.col(colour), i)
    luma = 0.299 * c(0) + 0.587 * c(1) + 0.114 * c(2)
    lim = rows.groupBy(F.col(by).alias("_k")).agg(nearest_rank(F.collect_list(luma), 0.02).alias("_lo"), nearest_rank(F.collect_list(luma), 0.98).alias("_hi"))
    x = rows.join(lim, F.col(by) == F.col("_k"))
    span = F.col("_hi") - F.col("_lo")
    grey = (c(0) + c(1) + c(2)) / 3
    lit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (grey - F.col("_lo")) / F.when(span != 0, span).otherwise(1.0)))
    shown = F.array(*[F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.floor(40 + 200 * lit + 3 * (c(i) - grey) + 0.5))) for i in range(3)])
    return x.withColumn("shown", shown).drop("_k", "_lo", "_hi")


def share_link(rows: Column, deflate: bool = False) -> Column:
    """A list of kept animals as text for an address: p plain or z deflated, base64 with the two address-safe signs."""
    body = F.to_json(rows).cast("binary")
    if deflate:
        body = F.pandas_udf(lambda s: s.map(_deflated), "binary")(body)
    return F.concat(F.lit("z" if deflate else "p"), F.regexp_replace(F.translate(F.base64(body), "+/\r\n", "-_"), "=+$", ""))


def unshared(link: Column, schema: str) -> Column:
    """The list that a link carries; null if it carries none."""
    text = F.substr(link, F.lit(2))
    body = F.try_to_binary(F.rpad(F.translate(text, "-_", "+/"), ((F.length(text) + 3) / 4).cast("int") * 4, F.lit("=")), F.lit("base64"))
    plain = F.when(link.startswith("z"), F.pandas_udf(lambda s: s.map(_inflated), "binary")(body)).otherwise(body)
    return F.from_json(plain.cast("string"), schema)


def _deflated(b: bytes | None) -> bytes | None:
    if b is None:
        return None
    z = zlib.compressobj(wbits=-15)
    return z.compress(b) + z.flush()


def _inflated(b: bytes | None) -> bytes | None:
    try:
        return None if b is None else zlib.decompress(b, wbits=-15)
    except zlib.error:
        return None
