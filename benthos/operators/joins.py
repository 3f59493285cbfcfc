"""Joins that time, place and names ask for, as equi-joins with bounded fan-out wherever there is a key."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Stretches of time that an as-of join is split into, in tolerances.
STRETCH = 64.0
#: Rows of a few numbers that may be broadcast, or numbered by one task.
FEW = 200_000


def small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has few rows; they are counted."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def asof_nearest(left: DataFrame, right: DataFrame, key: str, at: str, tolerance: float, payload: list[str], constant: DataFrame | None = None) -> DataFrame:
    """Each left row with the payload of the right row of its key nearest in `at` (seconds), within `tolerance`.

    Ties go to the earlier row.  `constant` (key, payload) has places that never change: a key with one takes
    it where no row is near, whatever the time.  Time is cut into stretches, so a key with most of the rows is
    many tasks; a right row near a cut goes to both sides.  One union and two running windows; no pair is made.
    """
    wide = max(tolerance, 1e-9) * STRETCH
    near = [F.floor((F.col(at) + d) / wide) for d in (-tolerance, 0.0, tolerance)]
    fix = F.struct(F.col(at).alias("_at"), *[F.col(c) for c in payload])
    none = F.lit(None)
    both = left.withColumn("_l", F.struct(*left.columns)).select(key, near[1].alias("_part"), F.col(at).alias("_when"), F.lit(1).alias("_side"), "_l", none.alias("_f")).unionByName(
        right.withColumn("_f", fix).select(key, F.explode(F.array_distinct(F.array(*near))).alias("_part"), F.col(at).alias("_when"), F.lit(0).alias("_side"), none.alias("_l"), "_f"), allowMissingColumns=True
    )
    so_far = lambda *order: F.last("_f", ignorenulls=True).over(Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = both.withColumn("_b", so_far("_when", "_side")).withColumn("_a", so_far(F.desc("_when"), "_side")).where("_side = 1")
    gap_b, gap_a = F.abs(F.col("_when") - F.col("_b._at")), F.abs(F.col("_a._at") - F.col("_when"))
    best = F.when(F.col("_a").isNull() | (gap_b <= gap_a), F.col("_b")).otherwise(F.col("_a"))
    x = x.withColumn("_n", best).withColumn("_n", F.when(F.abs(F.col("_n._at") - F.col("_when")) <= tolerance, F.col("_n")))
    out = x.select("_l.*", *[F.col(f"_n.{c}").alias(c) for c in payload])
    if constant is None:
        return out
    always = constant.select(F.col(key).alias("_key"), F.struct(*payload).alias("_c"))
    hit = F.coalesce(*[F.col(c).isNotNull() for c in payload[:1]], F.lit(False))
    return out.join(always, F.col(key) == F.col("_key"), "left").select(*left.columns, *[F.when(hit, F.col(c)).otherwise(F.col(f"_c.{c}")).alias(c) for c in payload])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bounds in order -> those after which another interval is the first open one, `_rank` being its rank or null."""
    heap, ended, said = [], set(), None
    for b in batches:
        keep, first = [], []
        ranks, opens, new, last = (b.column(c).to_pylist() for c in ("_rank", "_opens", "_new", "_last"))
        for i, rank in enumerate(ranks):
            if new[i]:
                heap, ended, said = [], set(), None
            if opens[i]:
                heappush(heap, rank)
            else:
                ended.add(rank)
            if last[i]:
                while heap and heap[0] in ended:
                    ended.remove(heappop(heap))
                top = heap[0] if heap else None
                if top != said:
                    keep.append(i)
                    first.append(top)
                    said = top
        out = b.drop_columns(["_rank", "_opens", "_new", "_last"]).take(pa.array(keep, pa.int64()))
        yield out.append_column("_rank", pa.array(first, pa.int64()))


def interval_first(left: DataFrame, right: DataFrame, at: str, start: str, stop: str, by: list[str], keys: list[str], on: list[str] | None = None) -> DataFrame:
    """Each left row with the first right row (by `by`, nulls last) whose [start, stop] holds `at`; a null stop is open.

    `keys` identify left rows; `on` are equi-keys that both sides share.  No pair is made: a sweep over the
    bounds of each key says which interval is the first from when on, a running window answers each distinct
    (key, at) once, and left rows meet one answer at most.  Sides are counted first: few answers go to the left
    rows, and of few intervals an answer is a number until the end, so left rows move once, by `keys`, and narrow.
    """
    on = on or []
    extra = [c for c in right.columns if c not in on]
    order = [x for b in by for x in (F.col(b).isNull().alias(f"_n{b}"), F.col(b).alias(f"_o{b}"))]
    same = [f"_on{i}" for i in range(len(on))] or ["_on"]
    keyed = lambda df: df.select("*", *([F.col(c).alias(s) for c, s in zip(on, same, strict=False)] or [F.lit(0).alias("_on")])).where(" and ".join(f"{s} is not null" for s in same))

    some = keyed(right).where(F.col(start).isNotNull() & (F.col(stop).isNull() | (F.col(start) <= F.col(stop))))
    some = some.select(*same, F.col(start).alias("_start"), F.col(stop).alias("_stop"), F.struct(*order, F.struct(*extra).alias("_r")).alias("_o"))
    few = right.limit(FEW + 1).count() <= FEW
    numbers = Window.orderBy("_o", *same) if few else Window.partitionBy(*same).orderBy("_o")
    ranked = some.withColumn("_rank", F.row_number().over(numbers).cast("long"))

    bound = lambda t, side: F.struct(F.col(t).alias("_t"), F.lit(side).alias("_side"), F.lit(side == 0).alias("_opens"))  # noqa: E731  left rows are side 1
    bounds = ranked.select(*same, "_rank", F.explode(F.array(bound("_start", 0), bound("_stop", 2))).alias("_b")).select(*same, "_b.*", "_rank").where("_t is not null")
    w = Window.partitionBy(*same).orderBy("_t", "_side")
    here, after = F.struct("_t", "_side"), F.lead(F.struct("_t", "_side")).over(w)
    bounds = bounds.withColumn("_new", F.row_number().over(w) == 1).withColumn("_last", ~here.eqNullSafe(after)).sortWithinPartitions(*same, "_t", "_side")
    kept = [f for f in bounds.schema if f.name in (*same, "_t", "_side")]
    firsts = bounds.mapInArrow(_sweep, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*kept, bounds.schema["_rank"]]))

    asked = keyed(left).select(*same, F.col(at).alias("_at")).where("_at is not null").distinct()
    both = asked.select(*same, "_at", F.col("_at").alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("struct<r: bigint>").alias("_f")).unionByName(firsts.select(*same, F.lit(None).cast(asked.schema["_at"].dataType).alias("_at"), "_t", "_side", F.struct(F.col("_rank").alias("r")).alias("_f")))
    told = both.withColumn("_f", F.last("_f", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("_side = 1 and _f.r is not null").select(*same, "_at", F.col("_f.r").alias("_rank"))
    told = told.withColumnRenamed("_rank", "_o") if few else told.join(ranked.select(*same, "_rank", "_o"), [*same, "_rank"]).drop("_rank")
    told = F.broadcast(told) if few and asked.limit(FEW + 1).count() <= FEW else told

    cond = F.col(f"l.{at}") == F.col("r._at")
    for c, s in zip(on, same, strict=False):
        cond &= F.col(f"l.{c}") == F.col(f"r.{s}")
    j = left.alias("l").join(told.alias("r"), cond, "left")
    g = j.groupBy(*[F.col(f"l.{k}").alias(f"_k{k}") for k in keys]).agg(*[F.any_value(F.col(f"l.{c}")).alias(c) for c in left.columns if c not in keys], F.min("r._o").alias("_o"))
    if few:
        g = g.withColumnRenamed("_o", "_rank").join(F.broadcast(ranked.select("_rank", "_o")), "_rank", "left")
    return g.select(*[F.col(f"_k{c}").alias(c) if c in keys else F.col(c) for c in left.columns], *[F.col(f"_o._r.{c}").alias(c) for c in extra])


def band(left: DataFrame, right: DataFrame, on: list[str], value: str, width: float) -> DataFrame:
    """Pairs of equal `on` whose `value` differ by less than `width`: a bucketed equi-join of three buckets a row."""
    bucket = lambda c: F.floor(c / width).cast("long")
    l = left.withColumn("_b", F.explode(F.array(*[bucket(F.col(value)) + d for d in (-1, 0, 1)])))
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumn("_rb", bucket(F.col(f"r_{value}")))
    cond = F.col("_b") == F.col("_rb")
    for c in on:
        cond &= F.col(c) == F.col(f"r_{c}")
    return l.join(r, cond).where(F.abs(F.col(value) - F.col(f"r_{value}")) < width).drop("_b", "_rb")


def longest_prefix(left: DataFrame, right: DataFrame, name: str, stem: str, strict: bool = True) -> DataFrame:
    """Each left name with the longest right stem that it equals or starts with (then "_" or "-" if strict).

    Each name is exploded into its own prefixes at separators, so this is an equi-join, not a theta join.
    """
    if strict:
        cuts = F.transform(F.filter(F.sequence(F.lit(2), F.greatest(F.length(name), F.lit(2))), lambda k: F.substr(F.col(name), k, F.lit(1)).isin("_", "-")), lambda k: F.substr(F.col(name), F.lit(1), k - 1))
        pieces = F.concat(F.array(F.col(name)), cuts)
    else:
        pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))), lambda k: F.substr(F.col(name), F.lit(1), k))
    x = left.withColumn("_p", F.explode(F.array_distinct(pieces)))
    j = x.join(right.withColumnRenamed(stem, "_stem"), F.col("_p") == F.col("_stem"))
    w = Window.partitionBy(name).orderBy(F.length("_stem").desc())
    found = j.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_p").withColumnRenamed("_stem", stem)
    extra = [c for c in found.columns if c not in left.columns]
    return left.join(found.select(F.col(name).alias("_n"), *extra), F.col(name) == F.col("_n"), "left").drop("_n")


def lookup(left: DataFrame, right: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join with a default for each looked-up column that is missing or empty."""
    j = left.join(right, key, "left")
    for c, d in defaults.items():
        j = j.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")) if isinstance(d, str) else F.col(c), F.lit(d)))
    return j


def remaining(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is wanted and not done yet."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def priority(left: DataFrame, *tries: tuple[DataFrame, str], key: str, columns: list[str]) -> DataFrame:
    """left with `columns` from the first source (tagged with its name) that has the key."""
    out = left
    for n, (df, tag) in enumerate(tries):
        out = out.join(df.select(F.col(key), F.struct(*columns, F.lit(tag).alias("source")).alias(f"_s{n}")), key, "left")
    best = F.coalesce(*[F.col(f"_s{n}") for n in range(len(tries))])
    return out.withColumn("_b", best).select(*left.columns, *[F.col(f"_b.{c}").alias(c) for c in [*columns, "source"]])


def merge_over(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; where both have one, the new row stands."""
    n = new.select(F.col(key).alias("_k"), F.struct(*new.columns).alias("_new"))
    j = old.select(F.col(key), F.struct(*old.columns).alias("_old")).join(n, F.col(key) == F.col("_k"), "full_outer")
    pick: Column = F.coalesce(F.col("_new"), F.col("_old"))
    return j.select(pick.alias("_p")).select("_p.*")


def placed_moments(slices: DataFrame, starts: DataFrame, fixes: DataFrame, tolerance: float, payload: list[str], constant: DataFrame | None = None) -> DataFrame:
    """slices (name, dim_t, fps) with recorded_at (seconds) and the payload of the nearest fix (name, at).

    A slice's moment is its recording's start and dim_t / fps, the start itself without either.  A recording
    without a start has neither moment nor place; a moment without a near fix has no place.
    """
    at = starts.select(F.col("name").alias("_name"), F.col("start").cast("double").alias("_start"))
    offset = F.when(F.col("dim_t").isNotNull() & (F.col("fps") != 0), F.col("dim_t") / F.col("fps")).otherwise(0.0)
    timed = slices.join(at, F.col("name") == F.col("_name"), "left").withColumn("recorded_at", F.col("_start") + offset).drop("_name", "_start")
    fix = fixes.withColumnRenamed("at", "recorded_at")
    known = asof_nearest(timed.where("recorded_at is not null"), fix, "name", "recorded_at", tolerance, payload, constant)
    return known.unionByName(timed.where("recorded_at is null"), allowMissingColumns=True)


def nearest_frame(found: DataFrame, annotated: DataFrame, on: list[str], fps: Column, first: int = 1) -> DataFrame:
    """found (on, second, ...) with `frame`: the annotated frame (on, frame) nearest in time among three, ties to the earlier.

    Detections without a second or rate, or over 1.5 frames off, are left out.  Three candidates a row and an equi-join.
    """
    middle = (F.bround(F.col("second") * F.col("_fps"), 0) + first).cast("long")
    x = found.withColumn("_fps", fps.cast("double")).where((F.col("_fps") > 0) & F.col("second").isNotNull()).withColumn("_id", F.struct(*found.columns)).withColumn("_f", F.explode(F.array(*[middle + d for d in (-1, 0, 1)])))
    a = annotated.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("frame").cast("long").alias("_frame")).distinct()
    cond = F.col("_f") == F.col("_frame")
    for c in on:
        cond &= F.col(c) == F.col(f"_{c}")
    off = F.abs((F.col("_f") - first) / F.col("_fps") - F.col("second"))
    w = Window.partitionBy("_id").orderBy("_off", "_f")
    near = x.join(a, cond).withColumn("_off", off).withColumn("_r", F.row_number().over(w)).where((F.col("_r") == 1) & (F.col("_off") <= F.lit(0.5) / F.col("_fps") * 3))
    return near.select(*found.columns, F.col("_f").alias("frame"))
