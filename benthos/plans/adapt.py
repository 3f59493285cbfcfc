"""The driver's tables seen as footage: slices, taxonomy, sightings, positions. No action is run here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benthos.storage import ship


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as report slices, a recording for each user."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    e = read(spark, sf_dir, "events").withColumn("k", k)
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    found = (F.col("event_type") == "purchase") & (F.col("k") % 2 == 0)
    zero = F.lit(0.0)
    return e.withColumn("i", i).select(
        F.concat(F.lit("rec_"), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("exp_"), (F.col("user_id") % 5).cast("string")).alias("expedition"),
        (F.col("i") * 30).cast("bigint").alias("dim_t"),
        F.lit(30.0).alias("fps"),
        F.lit(1).alias("obs_level"),
        F.when((F.col("event_type") == "error") & (F.col("k") % 2 == 0), zero).otherwise(F.col("value") / 10).alias("frame_difference"),
        F.col("k").cast("double").alias("std_intensity"),
        F.when(found, (1 + F.col("k") % 3).cast("double")).otherwise(zero).alias("detection_count"),
        F.when((F.col("event_type") == "signup") & (F.col("k") % 3 == 0), F.lit(1.0)).otherwise(zero).alias("moving_object_count"),
        F.when(found, F.concat(F.lit("NATION_"), (F.col("k") % 25).cast("string"))).alias("detection_top_class"),
        F.when(found, ((F.col("k") * 37) % 100).cast("double") / 100).alias("detection_confidence"),
        F.col("ts").alias("recorded_at"),
        (F.lit(200.0) + (F.col("user_id") * 37) % 4000 + F.col("value")).alias("depth_m"),
    )


SLICES = """base AS (
  SELECT event_id, user_id, ts, event_type, value, CAST(regexp_extract(props,'([0-9]+)',1) AS INT) AS k,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events),
slices AS (
  SELECT concat('rec_', CAST(user_id AS VARCHAR)) AS name, concat('exp_', CAST(user_id % 5 AS VARCHAR)) AS expedition,
         CAST(i*30 AS BIGINT) AS dim_t, CAST(30 AS DOUBLE) AS fps, 1 AS obs_level,
         CASE WHEN event_type='error' AND k%2=0 THEN CAST(0 AS DOUBLE) ELSE value/10 END AS frame_difference,
         CAST(k AS DOUBLE) AS std_intensity,
         CASE WHEN event_type='purchase' AND k%2=0 THEN CAST(1+k%3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS detection_count,
         CASE WHEN event_type='signup' AND k%3=0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS moving_object_count,
         CASE WHEN event_type='purchase' AND k%2=0 THEN concat('NATION_', CAST(k%25 AS VARCHAR)) END AS detection_top_class,
         CASE WHEN event_type='purchase' AND k%2=0 THEN CAST((k*37)%100 AS DOUBLE)/100 END AS detection_confidence,
         ts AS recorded_at, CAST(200 AS DOUBLE) + (user_id*37)%4000 + value AS depth_m
  FROM base)"""


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, kingdom, phylum, class) of the names that the register knows."""
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).where("n_nationkey % 7 <> 0").select(F.col("n_name").alias("name"), F.lit("Animalia").alias("kingdom"), F.col("r_name").alias("phylum"), F.concat(F.lit("class_"), (F.col("n_nationkey") % 3).cast("string")).alias("class"))


TAXONOMY = """taxonomy AS (
  SELECT n_name AS name, 'Animalia' AS kingdom, r_name AS phylum, concat('class_', CAST(n_nationkey % 3 AS VARCHAR)) AS class
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 0)"""


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as detections in frames, with `ord` as the stable input order."""
    li = read(spark, sf_dir, "lineitem")
    size = (F.col("l_quantity") + 10).cast("int")
    return li.select(
        F.concat(F.lit("rec_"), (F.col("l_suppkey") % 20).cast("string")).alias("recording"),
        ((F.col("l_orderkey") % 400) / F.lit(4.0)).alias("second"),
        F.concat(F.lit("NATION_"), (F.col("l_partkey") % 25).cast("string")).alias("taxon"),
        (((F.col("l_partkey") * 13 + F.col("l_linenumber") * 7 + F.col("l_suppkey")) % 100).cast("double") / 100).alias("confidence"),
        (F.col("l_partkey") * 31 % 560).cast("int").alias("x1"),
        (F.col("l_suppkey") * 17 % 300).cast("int").alias("y1"),
        ((F.col("l_partkey") * 31 % 560).cast("int") + size).alias("x2"),
        ((F.col("l_suppkey") * 17 % 300).cast("int") + size).alias("y2"),
        F.concat_ws("|", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0"), F.lpad((F.col("l_extendedprice") * 100).cast("bigint").cast("string"), 14, "0")).alias("ord"),
        (F.col("l_returnflag") == "R").alias("is_truth"),
    )


SIGHTINGS = """sightings AS (
  SELECT concat('rec_', CAST(l_suppkey % 20 AS VARCHAR)) AS recording, (l_orderkey % 400) / 4.0::DOUBLE AS second,
         concat('NATION_', CAST(l_partkey % 25 AS VARCHAR)) AS taxon,
         CAST((l_partkey*13 + l_linenumber*7 + l_suppkey) % 100 AS DOUBLE)/100 AS confidence,
         CAST(l_partkey*31 % 560 AS INT) AS x1, CAST(l_suppkey*17 % 300 AS INT) AS y1,
         CAST(l_partkey*31 % 560 AS INT) + CAST(trunc(l_quantity+10) AS INT) AS x2, CAST(l_suppkey*17 % 300 AS INT) + CAST(trunc(l_quantity+10) AS INT) AS y2,
         concat_ws('|', lpad(CAST(l_orderkey AS VARCHAR),12,'0'), CAST(l_linenumber AS VARCHAR), lpad(CAST(l_partkey AS VARCHAR),12,'0'), lpad(CAST(l_suppkey AS VARCHAR),12,'0'), lpad(CAST(CAST(trunc(l_extendedprice*100) AS BIGINT) AS VARCHAR),14,'0')) AS ord,
         l_returnflag = 'R' AS is_truth
  FROM lineitem)"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
