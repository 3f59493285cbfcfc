"""Kernels over small numeric planes: numpy in Arrow batches where SQL can't, expressions where it can."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the plane rules.
HUES, SATURATIONS, LIT, COLOURFUL = 12, 8, 0.08, 0.12
NARROW, WIDE, NARROW_LEAST, WIDE_LEAST, FITTED, AREA, DEVIATIONS = 1.5, 5.0, 0.8, 1.6, 1920 * 1080, 100.0, 5.0
WINDOW, FEWEST, LEAST_SIDE, MAX_SHIFT, RESIDUAL, DIFFERENCE, NOISE = 10, 4, 32, 60, 8.0, 14.0, 5.0
MIN_AREA, MIN_PIXELS, MAX_AREA = 3e-3, 16, 0.35
#: From a median absolute deviation to a standard deviation.
TO_SIGMA = 1.4826


def frame_differences(df: DataFrame, id_col: str, col: str, frames: int, pixels: int) -> DataFrame:
    """Mean and largest of the mean absolute difference between neighbouring frames; null for a single frame."""
    one = lambda f: F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(pixels - 1)), lambda i: F.abs(F.get(F.col(col), f * pixels + i).cast("double") - F.get(F.col(col), (f - 1) * pixels + i).cast("double"))), F.lit(0.0), lambda a, v: a + v) / pixels
    if frames < 2:
        return df.select(id_col, F.lit(None).cast("double").alias("mean_difference"), F.lit(None).cast("double").alias("max_difference"))
    d = df.select(id_col, F.transform(F.sequence(F.lit(1), F.lit(frames - 1)), one).alias("d"))
    return d.select(id_col, (F.aggregate("d", F.lit(0.0), lambda a, v: a + v) / (frames - 1)).alias("mean_difference"), F.array_max("d").alias("max_difference"))


def _pixels(df: DataFrame, id_col: str, col: str, channels: int) -> DataFrame:
    n = F.floor(F.size(col) / channels).cast("int")
    at = lambda k: F.get(F.col(col), F.col("i") * channels + k).cast("double")
    x = df.where(n > 0).select(id_col, col, F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    return x.select(id_col, at(0).alias("r"), at(1).alias("g"), at(2).alias("b"))


def channel_means(df: DataFrame, id_col: str, col: str, channels: int) -> DataFrame:
    return _pixels(df, id_col, col, channels).groupBy(id_col).agg(F.avg("r").alias("red"), F.avg("g").alias("green"), F.avg("b").alias("blue"))


def colourfulness(df: DataFrame, id_col: str, col: str, channels: int, full: float = 255.0) -> DataFrame:
    """Spread of the two opponent axes plus 0.3 of their mean offset, on the scale 0 to 255.

    Whole numbers are divided by `full`, others by the plane's peak where that is above 1.
    """
    rg, yb = F.col("r") - F.col("g"), (F.col("r") + F.col("g")) / 2 - F.col("b")
    spread = F.sqrt(F.var_pop(rg) + F.var_pop(yb)) + 0.3 * F.hypot(F.avg(rg), F.avg(yb))
    peak = F.greatest(F.lit(1.0), F.max(F.greatest("r", "g", "b"))) if _fractions(df, col) else F.lit(full)
    return _pixels(df, id_col, col, channels).groupBy(id_col).agg((spread / peak * 255.0).alias("colourfulness"))


def _fractions(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.elementType.typeName() in ("double", "float")


def _plane_rows(df: DataFrame, id_col: str, col: str, row: Callable[[np.ndarray], tuple | None], schema: str) -> DataFrame:
    """row(values) of every plane that isn't null, empty, or None by `row`."""
    kind = df.schema[id_col].dataType.simpleString()
    names = [id_col, *[c.split()[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = ((i, row(np.asarray(v, float))) for i, v in zip(b[id_col], b[col], strict=True) if v is not None and len(v))
            yield pd.DataFrame([(i, *out) for i, out in found if out is not None], columns=names)

    return df.select(id_col, col).mapInPandas(run, f"{id_col} {kind}, {schema}")


# --- colour -----------------------------------------------------------------------------------


def hsv(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue in turns, saturation and value of (..., 3) colours in [0, 1]; grey has hue 0."""
    top, low = rgb.max(-1), rgb.min(-1)
    span = top - low
    safe = np.maximum(span, 1e-6)
    r, g, b = rgb[..., 0], rgb[..., 1], rgb[..., 2]
    sixth = np.where(top == r, ((g - b) / safe) % 6, np.where(top == g, (b - r) / safe + 2, (r - g) / safe + 4))
    return np.where(span > 0, sixth / 6, 0.0), np.where(top > 0, span / np.maximum(top, 1e-6), 0.0), top


class Spread(NamedTuple):
    colourfulness: float
    saturation_mean: float
    colourful: float
    hues: list[float]
    saturations: list[float]


def spread_of(frames: np.ndarray) -> Spread | None:
    """The colours of a stack (frames, pixels, 3) in [0, 1], pooled; None if no pixel is lit.

    Saturations are shares of the lit pixels, hues of the saturation of those that have a colour to speak of.
    """
    hue, sat, value = hsv(frames)
    lit = value >= LIT
    n = int(lit.sum())
    if not n:
        return None
    strong = lit & (sat >= COLOURFUL)
    hues = np.bincount(np.minimum((hue[strong] * HUES).astype(int), HUES - 1), sat[strong], HUES)
    bins = np.bincount(np.minimum((sat[lit] * SATURATIONS).astype(int), SATURATIONS - 1), minlength=SATURATIONS) / n
    seen = frames[lit.any(-1)] * 255.0
    rg, yb = seen[..., 0] - seen[..., 1], (seen[..., 0] + seen[..., 1]) / 2 - seen[..., 2]
    scores = np.sqrt(rg.var(1) + yb.var(1)) + 0.3 * np.hypot(rg.mean(1), yb.mean(1))
    weight = hues.sum()
    return Spread(float(scores.mean()), float(sat[lit].mean()), float(bins[int(COLOURFUL * SATURATIONS) + 1 :].sum()), (hues / weight if weight > 0 else hues).tolist(), bins.tolist())


def colour_spread(df: DataFrame, id_col: str, col: str, channels: int, frames: int = 1, full: float = 255.0) -> DataFrame:
    """(id, colourfulness, saturation_mean, colourful, hues, saturations) of rows of `frames` frames of pixels.

    A row without lit pixels is left out, and so is one that is too short for a pixel a frame.
    """
    whole = not _fractions(df, col)

    def row(v: np.ndarray) -> Spread | None:
        pixels = len(v) // (frames * channels)
        if not pixels:
            return None
        p = v[: frames * pixels * channels].reshape(frames, pixels, channels)[..., :3]
        peaks = np.full(frames, full) if whole else np.maximum(1.0, np.nanmax(p, axis=(1, 2)))
        return spread_of(p / peaks[:, None, None])

    return _plane_rows(df, id_col, col, row, "colourfulness double, saturation_mean double, colourful double, hues array<double>, saturations array<double>")


# --- regions ----------------------------------------------------------------------------------


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Four-connected regions numbered from 1 in the order of their first pixel.

    A row's runs are joined to those they touch in the row above, so work follows the runs, not the area.
    """
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, start = np.nonzero(edge == 1)
    stop = np.nonzero(edge == -1)[1]
    root = list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    first = np.searchsorted(rows, np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        a, b = first[y - 1], first[y]
        while a < first[y] and b < first[y + 1]:
            if start[a] < stop[b] and start[b] < stop[a]:
                low, high = sorted((find(a), find(b)))
                root[high] = low
            if stop[a] < stop[b]:
                a += 1
            else:
                b += 1
    ids, of = np.unique([find(k) for k in range(len(rows))], return_inverse=True)
    out = np.zeros(mask.shape, np.int64)
    for y, s, e, k in zip(rows, start, stop, of, strict=True):
        out[y, s:e] = k + 1
    return out, len(ids)


def _box_max(mask: np.ndarray, reach: int) -> np.ndarray:
    """Whether any pixel within `reach` in both directions is set."""
    total = np.pad(mask.astype(np.int64), reach + 1)[:-1, :-1].cumsum(0).cumsum(1)
    side = 2 * reach + 1
    return total[side:, side:] - total[:-side, side:] - total[side:, :-side] + total[:-side, :-side] > 0


def closed(mask: np.ndarray, reach: int = 2) -> np.ndarray:
    """Grown by `reach` and shrunk again; outside the plane nothing is set, so its margin never is."""
    grown = np.zeros((mask.shape[0] + 2 * reach, mask.shape[1] + 2 * reach), bool)
    grown[reach:-reach, reach:-reach] = _box_max(mask, reach)
    return ~_box_max(~grown, reach)[reach:-reach, reach:-reach]


# --- particles --------------------------------------------------------------------------------


def blur(plane: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian to four sigmas, the plane mirrored at its edges."""
    r = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    weights /= weights.sum()
    out = plane.astype(float)
    for _ in range(2):  # down the columns, then along the rows
        wide = np.pad(out, ((r, r), (0, 0)), "symmetric")
        out = sum(w * wide[k : k + len(out)] for k, w in enumerate(weights)).T
    return out


def particles_of(plane: np.ndarray) -> tuple[int, float]:
    """Bright particles of a frame and the share of it that they cover.

    Sigmas and the least area were fitted at FITTED pixels and follow the frame's size.
    """
    scale = math.sqrt(plane.size / FITTED)
    band = blur(plane, max(NARROW_LEAST, NARROW * scale)) - blur(plane, max(WIDE_LEAST, WIDE * scale))
    middle = np.median(band)
    spread = float(np.median(np.abs(band - middle))) or 1.0
    lab, n = label(band > middle + DEVIATIONS * TO_SIGMA * spread)
    areas = np.bincount(lab.ravel(), minlength=n + 1)[1:]
    areas = areas[areas >= AREA * scale * scale]
    return len(areas), float(areas.sum() / plane.size)


def picks(n: int, sample: int) -> np.ndarray:
    """At most `sample` of n frames, evenly spread from the first to the last."""
    return np.unique(np.linspace(0, n - 1, min(sample, n)).astype(int)) if n else np.zeros(0, int)


def bright_particles(df: DataFrame, id_col: str, col: str, shape: tuple[int, int], sample: int = 3) -> DataFrame:
    """(id, particles, area): means over `sample` frames of each row's frames; rows without a whole frame are left out."""
    size = shape[0] * shape[1]

    def row(v: np.ndarray) -> tuple[float, float] | None:
        at = picks(len(v) // size, sample)
        return tuple(np.mean([particles_of(v[k * size : (k + 1) * size].reshape(shape)) for k in at], axis=0).tolist()) if len(at) else None

    return _plane_rows(df, id_col, col, row, "particles double, area double")


# --- movement ---------------------------------------------------------------------------------


def shifts_to(frames: np.ndarray, still: np.ndarray) -> np.ndarray:
    """How far (down, right) each frame lies from `still`, by phase correlation; beyond half the frame it wraps."""
    cross = np.fft.rfft2(frames) * np.conj(np.fft.rfft2(still))
    peaks = np.fft.irfft2(cross / (np.abs(cross) + 1e-9), s=still.shape).reshape(len(frames), -1).argmax(1)
    at = np.stack(np.unravel_index(peaks, still.shape), 1)
    size = np.array(still.shape)
    return np.where(at > size // 2, at - size, at)


class Movers(NamedTuple):
    speed: float
    objects: float
    area: float
    box: list[int] | None  # left, top, right, bottom of the largest


def steadied(window: np.ndarray) -> np.ndarray | None:
    """The window's frames brought onto its middle one, without what was rolled in; None if that can't be trusted."""
    moves = shifts_to(window, window[len(window) // 2])
    reach = int(np.abs(moves).max())
    cut = max(1, reach)
    if reach > MAX_SHIFT or min(window.shape[1:]) - 2 * cut < LEAST_SIDE:
        return None
    return np.stack([np.roll(f, tuple(-m), (0, 1))[cut:-cut, cut:-cut] for f, m in zip(window, moves, strict=True)])


def objects_in(steady: np.ndarray, least: float = MIN_AREA) -> tuple[float, float, list[int]] | None:
    """Regions of the middle frame that differ from the window's background: count, largest share, its box."""
    off = np.abs(steady - np.median(steady, 0))
    here = off[len(off) // 2]
    if np.median(here) > RESIDUAL:
        return None
    lab, n = label(closed(here > np.maximum(DIFFERENCE, NOISE * np.median(off, 0))))
    areas = np.bincount(lab.ravel(), minlength=n + 1)[1:]
    enough = areas >= max(MIN_PIXELS, int(least * here.size))
    if not enough.any():
        return None
    big = int(np.where(enough, areas, 0).argmax())
    share = float(areas[big] / here.size)
    if share > MAX_AREA:
        return None
    y, x = np.nonzero(lab == big + 1)
    return float(enough.sum()), share, [int(x.min()), int(y.min()), int(x.max()), int(y.max())]


def movers_of(frames: np.ndarray, seconds: float = 1.0, least: float = MIN_AREA) -> Movers:
    """Camera speed in pixels a second (median of the windows), and the objects of the busiest window.

    Fewer than FEWEST frames or sides under LEAST_SIDE have no speed and no objects.
    """
    if len(frames) < FEWEST or min(frames.shape[1:]) < LEAST_SIDE:
        return Movers(math.nan, 0.0, 0.0, None)
    step = seconds / (len(frames) - 1)
    whole = max(1, len(frames) // WINDOW)
    speeds, best = [], Movers(math.nan, 0.0, 0.0, None)
    for k in range(whole):
        window = frames[k * WINDOW : (k + 1) * WINDOW]
        gone = shifts_to(window[:1], window[-1])[0]
        speeds.append(math.hypot(*gone) / max(1e-6, (len(window) - 1) * step))
        steady = steadied(window)
        found = objects_in(steady, least) if steady is not None else None
        if found and found[1] > best.area:
            best = Movers(math.nan, *found)
    return best._replace(speed=float(np.median(speeds)))


def moving_objects(df: DataFrame, id_col: str, col: str, shape: tuple[int, int], seconds: float = 1.0) -> DataFrame:
    """(id, camera_speed, objects, area, box) of rows that hold frames one after another."""
    size = shape[0] * shape[1]
    return _plane_rows(df, id_col, col, lambda v: movers_of(v[: len(v) // size * size].reshape(-1, *shape), seconds), "camera_speed double, objects double, area double, box array<int>")


# --- thumbnails -------------------------------------------------------------------------------


def thumbnails(df: DataFrame, id_col: str, col: str, shape: tuple[int, int], width: int = 128) -> DataFrame:
    """(id, height, width, plane): the middle frame of each row by its nearest pixels, at most `width` wide, as 0 to 255.

    Values are scaled by the frame's peak; frames with a side under 8 and rows without a frame have a null plane.
    """
    h, w = shape
    wide = min(w, width)
    high = h if w <= width else max(1, round(h * width / w))
    frames = F.floor(F.size(col) / (h * w)).cast("int")
    first = F.floor(frames / 2).cast("int") * (h * w)
    at = lambda i: F.floor(F.floor(i / wide) * h / high).cast("int") * w + F.floor(i % wide * w / wide).cast("int")
    frame = F.slice(F.col(col), first + 1, F.lit(h * w))
    some = (frames > 0) & F.lit(min(shape) >= 8)
    x = df.select(id_col, F.when(some, F.transform(frame, lambda v: v.cast("double"))).alias("f"))
    top = F.array_max(F.filter("f", lambda v: ~F.isnan(v) & (F.abs(v) != float("inf"))))
    small = F.transform(F.sequence(F.lit(0), F.lit(high * wide - 1)), lambda i: F.get("f", at(i)))
    shown = F.transform(small, lambda v: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), v / F.coalesce(F.nullif(top, F.lit(0.0)), F.lit(1.0)) * 255.0))).cast("int"))
    return x.select(id_col, F.lit(high).alias("height"), F.lit(wide).alias("width"), F.when(F.col("f").isNotNull(), shown).alias("plane"))
