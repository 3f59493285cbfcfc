"""Where results go: reports, tables, CSV lists, tile pages and reels.

Every writer makes a new folder and moves it into place, so a job that dies leaves the old result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benthos.functions import exprs as x

#: Bytes of a parquet row group: reports hold pictures, and readers take one group at a time.
ROW_GROUP = 48_000_000


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def replace(df: DataFrame, path: str, kind: str = "parquet", by: list[str] | None = None, **options: str) -> None:
    """Write beside `path`, then move over it; df may read `path` itself. On failure the old one stays."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    w = df.write.format(kind).options(**options)
    try:
        (w.partitionBy(*by) if by else w).save(beside)
    except Exception:
        p, fs = _fs(spark, beside)
        fs.delete(p, True)
        raise
    src, fs = _fs(spark, beside)
    dst, _ = _fs(spark, path)
    old, _ = _fs(spark, f"{beside}-old")
    had = fs.exists(dst)
    if had:
        fs.rename(dst, old)
    fs.rename(src, dst)
    if had:
        fs.delete(old, True)


def write_report(df: DataFrame, path: str) -> None:
    replace(df, path, **{"parquet.block.size": str(ROW_GROUP)})


def write_meta(spark: SparkSession, path: str, meta: dict[str, str]) -> None:
    """The side table that stands for footer key-values, which Spark can't write."""
    replace(spark.createDataFrame([meta], ", ".join(f"{k} string" for k in meta)), f"{path.rstrip('/')}_meta", "json")


def read_meta(spark: SparkSession, path: str) -> dict[str, str]:
    p, fs = _fs(spark, f"{path.rstrip('/')}_meta")
    return spark.read.json(f"{path.rstrip('/')}_meta").first().asDict() if fs.exists(p) else {}


def sightings_csv(s: DataFrame) -> DataFrame:
    """Columns of the sightings list, as text: seconds to 2 places, confidence to 3."""
    sec = F.col("second")
    return s.select("recording", F.format_string("%.2f", sec).alias("second"), x.timecode(sec).alias("timecode"), "frame", "taxon", F.format_string("%.3f", "confidence").alias("confidence"), "x1", "y1", "x2", "y2")


def keyed_sightings(s: DataFrame) -> DataFrame:
    """Sightings under the report's own keys (name, dim_t), so that they join straight to its slices."""
    return s.select(F.col("recording").alias("name"), F.col("slice_t").alias("dim_t"), "frame", "second", x.timecode(F.col("second")).alias("timecode"), "taxon", "confidence", "x1", "y1", "x2", "y2", "crop")


def write_sightings(s: DataFrame, path: str) -> None:
    replace(keyed_sightings(s), path)


def page_blobs(tiles: DataFrame, picture: str, by: list[str], order: list[str]) -> DataFrame:
    """(by, lengths, blob): the pictures of each tile page one after another, and how long each is. A page has PAGE tiles at most."""
    p = F.transform(F.sort_array(F.collect_list(F.struct(*order, F.coalesce(F.col(picture), F.lit(b"")).alias("p")))), lambda v: v["p"])
    return tiles.groupBy(*by).agg(p.alias("p")).select(*by, F.transform("p", F.octet_length).alias("lengths"), F.aggregate("p", F.lit(b""), lambda a, v: F.concat(a, v)).alias("blob"))


def events_csv(events: DataFrame, fps: Column) -> DataFrame:
    """Columns of the event list for annotation tools; missing numbers are empty."""
    rate = F.when(fps != 0, fps).otherwise(1.0)
    start, stop = F.col("from_t") / rate, F.col("to_t") / rate
    num = lambda c, n: F.coalesce(F.format_string(f"%.{n}f", c), F.lit("")) if isinstance(c, str) else F.format_string(f"%.{n}f", c)
    maybe = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.2f", c)).otherwise("")
    return events.select(F.col("name").alias("recording"), num(start, 2).alias("start_seconds"), num(stop, 2).alias("end_seconds"), x.clock(start).alias("start_timecode"), "kind", num(F.col("movement"), 4).alias("movement"), num(F.col("score"), 2).alias("score"), maybe("detections").alias("animals"), F.coalesce("top_class", F.lit("")).alias("taxon"), maybe("confidence").alias("certainty_0_to_1"))


def favourites_csv(favourites: DataFrame, terms: DataFrame) -> DataFrame:
    """Kept animals with the credit and licence of their archive."""
    return favourites.join(terms, "archive", "left").select("expedition", "recording", F.format_string("%.2f", "second").alias("second"), "taxon", F.coalesce("guess", F.lit("")).alias("guess"), F.coalesce("credit", F.lit("")).alias("credit"), F.coalesce("licence", F.lit("")).alias("licence"))


def write_csv(df: DataFrame, path: str) -> None:
    replace(df, path, "csv", header="true", escape='"')


def write_table(df: DataFrame, path: str) -> None:
    """A small table as JSON lines: progress, scores, the tile index."""
    replace(df.coalesce(1), path, "json")


def write_pages(tiles: DataFrame, path: str) -> None:
    """Tile pages as taxon=.../page=... JSON, tiles in order; pictures stay in their own columns, joined late."""
    order = tiles.withColumn("taxon", x.slug(F.col("taxon"))).repartition("taxon", "page").sortWithinPartitions("taxon", "page", "at")
    replace(order, path, "json", ["taxon", "page"])


def write_reels(animals: DataFrame, path: str) -> None:
    """Each recording's animals with their looks, under a file name of its own."""
    replace(animals.repartition("expedition", "file").sortWithinPartitions("expedition", "file", "first_second", "animal"), path, "json", ["expedition", "file"])
