"""Trees of names and what the page draws from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benthos.functions.exprs import lineage

PAGE = 60
SEP = ">"


def lineages(taxonomy: DataFrame, names: DataFrame) -> DataFrame:
    """(taxon, lineage) of every name."""
    t = taxonomy.select(F.col("name").alias("_n"), "kingdom", "phylum", "class")
    return names.join(t, names["taxon"] == t["_n"], "left").withColumn("lineage", lineage([F.col("kingdom"), F.col("phylum"), F.col("class")], F.col("taxon"), F.col("_n").isNotNull())).drop("_n", "kingdom", "phylum", "class")


def tree(counts: DataFrame) -> DataFrame:
    """counts (lineage, n) -> (path, parent, name, depth, count): every node with all that is under it."""
    x = counts.select("n", "lineage", F.explode(F.sequence(F.lit(1), F.size("lineage"))).alias("depth"))
    path = F.array_join(F.slice("lineage", F.lit(1), F.col("depth")), SEP)
    parent = F.array_join(F.slice("lineage", F.lit(1), F.col("depth") - 1), SEP)
    return x.groupBy(path.alias("path"), parent.alias("parent"), F.get("lineage", F.col("depth") - 1).alias("name"), "depth").agg(F.sum("n").alias("count"))


def children(nodes: DataFrame) -> DataFrame:
    """(path, names): the names under each node, most counted first."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), "name")))
    return nodes.groupBy(F.col("parent").alias("path")).agg(F.transform(order, lambda v: v["name"]).alias("names"))


def leftover(nodes: DataFrame) -> DataFrame:
    """(path, leftover): what of a node is in none of its children, where that is above 0."""
    under = nodes.groupBy(F.col("parent").alias("path")).agg(F.sum("count").alias("inner"))
    return nodes.join(under, "path", "left").select("path", (F.col("count") - F.coalesce("inner", F.lit(0))).alias("leftover")).where("leftover > 0")


def rings(nodes: DataFrame, depth: int = 3, least: float = 0.004) -> DataFrame:
    """(path, depth, start, span): a node's share of the circle, laid out biggest first inside its parent.

    Each level is one window over its parents, so there are as many steps as rings.
    """
    top = nodes.where("depth = 1")
    total = Window.partitionBy()
    order = lambda *p: Window.partitionBy(*p).orderBy(F.desc("count"), "name").rowsBetween(Window.unboundedPreceding, -1)
    share = F.col("count") / F.sum("count").over(total)
    level = top.select("path", "depth", "count", share.alias("span"), (F.coalesce(F.sum("count").over(order()), F.lit(0)) / F.sum("count").over(total)).alias("start"))
    out = level
    for d in range(2, depth + 1):
        up = level.select(F.col("path").alias("parent"), F.col("span").alias("ps"), F.col("start").alias("pa"), F.col("count").alias("pc"))
        before = F.coalesce(F.sum("count").over(order("parent")), F.lit(0))
        level = nodes.where(F.col("depth") == d).join(up, "parent").select("path", "depth", "count", (F.col("ps") * F.col("count") / F.col("pc")).alias("span"), (F.col("pa") + F.col("ps") * before / F.col("pc")).alias("start"))
        out = out.unionByName(level)
    return out.where(F.col("span") >= least).select("path", "depth", "start", "span")


def search(names: DataFrame, text: str, most: int = 12) -> DataFrame:
    """The first names that hold `text`, earliest position first, then most counted."""
    at = F.instr(F.lower("name"), text.lower())
    return names.withColumn("at", at).where("at > 0").orderBy("at", F.desc("count"), "name").limit(most)


def pages(animals: DataFrame, taxon: str, confidence: str, tie: list[str], size: int = PAGE) -> DataFrame:
    """animals with page and at: numbered within their taxon, most confident first."""
    n = F.row_number().over(Window.partitionBy(taxon).orderBy(F.desc(confidence), *tie)) - 1
    return animals.withColumn("_n", n).withColumn("page", F.floor(F.col("_n") / size).cast("long")).withColumn("at", (F.col("_n") % size).cast("long")).drop("_n")


def offsets(tiles: DataFrame, by: list[str], order: list[str], length: Column) -> DataFrame:
    """tiles with `start`: the lengths that come before within their page."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return tiles.withColumn("start", F.coalesce(F.sum(length).over(w), F.lit(0)).cast("long"))


def unique_slugs(names: DataFrame, slug: Column, by: list[str]) -> DataFrame:
    """names with a file name of their own: the slug, then slug-2, slug-3 ... in name order."""
    x = names.withColumn("_s", slug)
    n = F.row_number().over(Window.partitionBy(*by, "_s").orderBy("name"))
    return x.withColumn("file", F.when(n == 1, F.col("_s")).otherwise(F.concat_ws("-", "_s", n.cast("string")))).drop("_s")
