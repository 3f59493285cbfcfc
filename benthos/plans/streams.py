"""Streaming queries, run over what is there (availableNow) and equal to their batch forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from benthos.storage import shared_dir
from benthos.streaming import jobs

from . import adapt
from .registry import query


def _events(spark, sf_dir):
    schema = adapt.read(spark, sf_dir, "events").schema
    return jobs.parts(spark, sf_dir, schema, "events.parquet").withColumn("at", F.col("ts").cast("timestamp"))


def _run(spark, df, mode):
    tag = uuid.uuid4().hex
    return jobs.run_once(df, f"q_{tag}", mode, f"{shared_dir(spark)}/stream-{tag}")


@query("""SELECT event_type, count(*) AS points, min(ts) AS start, max(ts) AS stop FROM (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY ts) AS n FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) <= INTERVAL 20 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY event_type, n""")
def stream_sessions(spark, sf_dir):
    s = jobs.sessions(_events(spark, sf_dir), "at", "20 minutes", "1 day", ["event_type"])
    return _run(spark, s, "complete").select("event_type", "points", F.col("start").cast("timestamp_ntz").alias("start"), F.col("stop").cast("timestamp_ntz").alias("stop"))


@query("SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS bucket, round(sum(value), 4) AS animals, count(*) AS slices FROM events GROUP BY 1, 2")
def stream_buckets(spark, sf_dir):
    b = jobs.buckets(_events(spark, sf_dir), "at", "1 day", "1 day", ["event_type"], "value")
    return _run(spark, b, "complete").select("event_type", F.col("bucket").cast("timestamp_ntz").alias("bucket"), F.round("animals", 4).alias("animals"), "slices")


@query("SELECT user_id, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def stream_first_seen(spark, sf_dir):
    """Each user's kinds of event, each seen once."""
    e = _events(spark, sf_dir).withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    return _run(spark, jobs.first_seen(e, "key", "at", "1 day"), "append").groupBy("user_id").agg(F.count("*").alias("kinds"))
