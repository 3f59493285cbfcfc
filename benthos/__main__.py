"""python -m benthos VERB ...: the passes over reports, one Spark job each."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from benthos.functions import exprs
from benthos.operators import choices, joins, reports, selection
from benthos.sources import listings, parts, sinks


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser("benthos")
    sub = p.add_subparsers(dest="verb", required=True)
    for verb, args in {"list": ["pages", "out"], "choose": ["manifest", "out"], "remaining": ["manifest", "done", "out"], "merge": ["parts", "out"], "identify": ["report", "taxonomy"], "judge": ["report"], "slim": ["report"], "page": ["report", "out"], "unreadable": ["root", "out"], "run": ["parts", "taxonomy", "out"], "score": ["report", "truth", "out"], "site": ["rows", "out"]}.items():
        s = sub.add_parser(verb)
        for a in args:
            s.add_argument(a)
    for name in ("dives", "per_dive", "most"):
        sub.choices["choose"].add_argument(f"--{name.replace('_', '-')}", type=int, default=0)
    sub.choices["choose"].add_argument("--reports", help="a folder of dive reports, for how deep each dive went")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"benthos {a.verb}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.verb == "list":
        sinks.write_table(listings.links(spark.read.parquet(a.pages), "page_id", "html"), a.out)
    elif a.verb == "choose":
        v = listings.manifest(spark, a.manifest).withColumn("dive", exprs.dive_number(F.col("url")))
        if a.reports:
            texts = spark.read.option("wholetext", "true").text(a.reports).select(exprs.dive_number(F.col("_metadata.file_name")).alias("dive"), F.col("value").alias("text"))
            v = v.join(listings.dive_summary(texts).groupBy("dive").agg(F.max("max_depth_m").alias("depth_m")), "dive", "left")
        else:
            v = v.withColumn("depth_m", F.lit(None).cast("double"))
        sinks.write_table(selection.choose(v, a.dives or 1_000_000, a.per_dive, a.most), a.out)
    elif a.verb == "remaining":
        done = parts.read_parts(spark, a.done).select(F.col("name").alias("stem"))
        sinks.write_table(joins.remaining(listings.manifest(spark, a.manifest).withColumn("stem", exprs.stem(F.col("url"))), done, "stem"), a.out)
    elif a.verb == "merge":
        sinks.write_report(reports.without_clips(parts.read_parts(spark, a.parts)), a.out)
    elif a.verb == "identify":
        sinks.write_report(reports.identify(spark.read.parquet(a.report), spark.read.parquet(a.taxonomy)), a.report)
    elif a.verb == "judge":
        sinks.write_report(reports.judge(spark.read.parquet(a.report)), a.report)
    elif a.verb == "slim":
        sinks.write_report(reports.slim(spark.read.parquet(a.report)), a.report)
    elif a.verb == "page":
        sinks.write_table(reports.progress(spark.read.parquet(a.report)), a.out)
    elif a.verb == "run":
        sinks.write_report(reports.built(parts.read_parts(spark, a.parts), spark.read.parquet(a.taxonomy)), a.out)
    elif a.verb == "score":
        sinks.write_table(reports.scored(spark.read.parquet(a.report), spark.read.parquet(a.truth))[0], a.out)
    elif a.verb == "site":
        rows = spark.read.parquet(a.rows)
        sinks.write_table(choices.share(rows), f"{a.out}/expeditions")
        sinks.write_table(choices.totals(rows), f"{a.out}/totals")
    elif a.verb == "unreadable":
        sinks.write_table(parts.unreadable(spark, a.root), a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
