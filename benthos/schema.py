"""The layout of a report, and how any parquet is brought to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that queries may ask for and their types; a report that lacks one has nulls.
REPORT = (
    "name STRING, child_id STRING, obs_level INT, dim_t BIGINT, dim_c INT, fps DOUBLE, frame_difference DOUBLE, std_intensity DOUBLE, "
    "laplacian_variance DOUBLE, detection_count DOUBLE, moving_object_count DOUBLE, bright_particle_count DOUBLE, detection_top_class STRING, "
    "detection_confidence DOUBLE, detections STRING, detection_crop BINARY, slice_thumbnail BINARY, recorded_at TIMESTAMP_NTZ, depth_m DOUBLE, altitude_m DOUBLE, "
    "latitude DOUBLE, longitude DOUBLE, slice_red DOUBLE, slice_green DOUBLE, slice_blue DOUBLE, expedition STRING, slice_verdict STRING"
)

#: One entry of the detections list. `clip` is text because writers use both true and 1.
DETECTION = "array<struct<second: double, frame: int, class: string, conf: double, box: array<int>, crop: string, clip: string, of: int, cut: array<int>, animal: int, animal_taxon: string, animal_agreement: double>>"


def ensure(df: DataFrame, schema: str = REPORT) -> DataFrame:
    """df with every column of `schema`, cast to its type; its other columns follow untouched."""
    have = {c.lower(): c for c in df.columns}
    fields = [f.split() for f in schema.split(", ")]
    known = [(F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in fields]
    names = {n.lower() for n, _ in fields}
    return df.select(*known, *[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def slices(df: DataFrame) -> DataFrame:
    """Rows at the slice grain: level 1, a time, and no channel where channels exist."""
    keep = (F.col("obs_level") == 1) & F.col("dim_t").isNotNull()
    return df.where(keep & F.col("dim_c").isNull() if "dim_c" in df.columns else keep)


def recordings(df: DataFrame) -> DataFrame:
    """The rows that carry per-recording totals."""
    return df.where((F.col("obs_level") == 0) & F.col("dim_t").isNull())


def recording_key(df: DataFrame) -> Column:
    """child_id where there is one, else name."""
    return F.coalesce("child_id", "name") if "child_id" in df.columns else F.col("name")


def detections(text: Column) -> Column:
    """The list of detections; malformed text is null."""
    return F.from_json(text, DETECTION)


def is_clip(entry: Column) -> Column:
    return F.coalesce(F.lower(entry["clip"]).isin("true", "1"), F.lit(False))


def without_clips(entries: Column) -> Column:
    """The list without clip frames; null if nothing is left."""
    kept = F.filter(entries, lambda d: ~is_clip(d))
    return F.when(F.size(kept) > 0, kept)


def to_text(entries: Column) -> Column:
    """Back to compact JSON text; null fields are left out."""
    return F.to_json(entries)
