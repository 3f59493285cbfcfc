"""Queries over the tree of names, tile pages, reels, and the choice of recordings."""

from __future__ import annotations

from pyspark.sql import functions as F

from benthos.functions.exprs import slug
from benthos.operators import hierarchy as h
from benthos.operators import selection as sel

from . import adapt
from .adapt import SIGHTINGS, SLICES, TAXONOMY, read, with_sql
from .registry import query

COUNTS = """counts AS (SELECT detection_top_class AS taxon, CAST(sum(detection_count) AS BIGINT) AS n FROM slices WHERE detection_top_class IS NOT NULL GROUP BY 1),
lin AS (SELECT taxon, n, CASE WHEN t.name IS NOT NULL THEN [kingdom, phylum, class, taxon] ELSE ['Unplaced', taxon] END AS lineage FROM counts LEFT JOIN taxonomy t ON t.name = taxon),
nodes AS (SELECT array_to_string(lineage[1:d], '>') AS path, array_to_string(lineage[1:d-1], '>') AS parent, lineage[d] AS name, CAST(d AS BIGINT) AS depth, CAST(sum(n) AS BIGINT) AS count FROM (SELECT *, unnest(range(1, len(lineage)+1)) AS d FROM lin) GROUP BY 1, 2, 3, 4)"""
_T = with_sql(SLICES, TAXONOMY, COUNTS)


def _counts(spark, sf_dir):
    n = adapt.slices(spark, sf_dir).where("detection_top_class is not null").groupBy(F.col("detection_top_class").alias("taxon")).agg(F.sum("detection_count").cast("bigint").alias("n"))
    return h.lineages(adapt.taxonomy(spark, sf_dir), n)


def _nodes(spark, sf_dir):
    return h.tree(_counts(spark, sf_dir))


@query(_T + "SELECT path, parent, name, depth, count FROM nodes")
def tree_counts(spark, sf_dir):
    return _nodes(spark, sf_dir).select("path", "parent", "name", F.col("depth").cast("bigint").alias("depth"), "count")


@query(_T + "SELECT n.path, CAST(n.count - coalesce(c.inner_, 0) AS BIGINT) AS leftover FROM nodes n LEFT JOIN (SELECT parent, sum(count) AS inner_ FROM nodes GROUP BY 1) c ON c.parent = n.path WHERE n.count - coalesce(c.inner_, 0) > 0")
def tree_leftover(spark, sf_dir):
    return h.leftover(_nodes(spark, sf_dir))


@query(_T + """, r1 AS (SELECT path, count, count / sum(count) OVER () AS span, coalesce(sum(count) OVER (ORDER BY count DESC, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(count) OVER () AS start FROM nodes WHERE depth = 1),
r2 AS (SELECT n.path, n.count, u.span * n.count / u.count AS span, u.start + u.span * coalesce(sum(n.count) OVER (PARTITION BY n.parent ORDER BY n.count DESC, n.name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / u.count AS start FROM nodes n JOIN r1 u ON u.path = n.parent WHERE n.depth = 2),
r3 AS (SELECT n.path, n.count, u.span * n.count / u.count AS span, u.start + u.span * coalesce(sum(n.count) OVER (PARTITION BY n.parent ORDER BY n.count DESC, n.name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / u.count AS start FROM nodes n JOIN r2 u ON u.path = n.parent WHERE n.depth = 3)
SELECT path, CAST(depth AS BIGINT) AS depth, round(start, 6) AS start, round(span, 6) AS span FROM (SELECT path, 1 AS depth, start, span FROM r1 UNION ALL SELECT path, 2, start, span FROM r2 UNION ALL SELECT path, 3, start, span FROM r3) WHERE span >= 0.004""")
def ring_layout(spark, sf_dir):
    return h.rings(_nodes(spark, sf_dir)).select("path", F.col("depth").cast("bigint").alias("depth"), F.round("start", 6).alias("start"), F.round("span", 6).alias("span"))


@query(_T + "SELECT name, count FROM nodes WHERE depth = 2 ORDER BY count DESC")
def jump_row(spark, sf_dir):
    return _nodes(spark, sf_dir).where("depth = 2").orderBy(F.desc("count"), "name").select("name", "count")


@query(_T + "SELECT name, count, CAST(instr(lower(name), 'n_1') AS BIGINT) AS \"at\" FROM (SELECT name, max(count) AS count FROM nodes GROUP BY name) WHERE instr(lower(name), 'n_1') > 0 ORDER BY 3, count DESC, name LIMIT 12")
def taxon_search(spark, sf_dir):
    """The feature is a list of the twelve best matches."""
    names = _nodes(spark, sf_dir).groupBy("name").agg(F.max("count").alias("count"))
    return h.search(names, "n_1").select("name", "count", F.col("at").cast("bigint").alias("at"))


@query(_T + "SELECT phylum, CAST(count(*) AS BIGINT) AS richness, CAST(sum(n) AS BIGINT) AS abundance FROM (SELECT n, CASE WHEN len(lineage) > 2 THEN lineage[2] ELSE lineage[1] END AS phylum FROM lin) GROUP BY 1")
def richness_and_abundance(spark, sf_dir):
    trunk = F.when(F.size("lineage") > 2, F.get("lineage", 1)).otherwise(F.get("lineage", 0))
    return _counts(spark, sf_dir).groupBy(trunk.alias("phylum")).agg(F.count("*").alias("richness"), F.sum("n").alias("abundance"))


@query(with_sql(SIGHTINGS) + "SELECT ord, recording, second, taxon, CAST((r - 1) // 60 AS BIGINT) AS page, CAST((r - 1) % 60 AS BIGINT) AS at FROM (SELECT *, row_number() OVER (PARTITION BY taxon ORDER BY confidence DESC, ord) AS r FROM sightings)")
def tile_pages(spark, sf_dir):
    return h.pages(adapt.sightings(spark, sf_dir), "taxon", "confidence", ["ord"]).select("ord", "recording", "second", "taxon", "page", "at")


@query(with_sql(SIGHTINGS) + "SELECT ord, CAST(coalesce(sum(length(ord) + x2 - x1) OVER (PARTITION BY recording ORDER BY second, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM sightings")
def tile_offsets(spark, sf_dir):
    return h.offsets(adapt.sightings(spark, sf_dir), ["recording"], ["second", "ord"], F.length("ord") + F.col("x2") - F.col("x1")).select("ord", "start")


@query("""SELECT name, CASE WHEN n = 1 THEN s ELSE concat(s, '-', CAST(n AS VARCHAR)) END AS file FROM (SELECT name, s, row_number() OVER (PARTITION BY s ORDER BY name) AS n FROM (SELECT name, coalesce(nullif(regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), ''), 'unnamed') AS s FROM (SELECT DISTINCT url AS name FROM pages)))""")
def reel_slugs(spark, sf_dir):
    return h.unique_slugs(read(spark, sf_dir, "pages").select(F.col("url").alias("name")).distinct(), slug(F.col("name")), []).select("name", "file")


VIDEOS = "videos AS (SELECT o_orderkey AS no, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS url, CAST(o_custkey % 50 AS INT) AS dive, o_orderdate AS recorded_at, o_totalprice AS depth_m FROM orders)"


def _videos(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("url"), (F.col("o_custkey") % 50).cast("int").alias("dive"), F.col("o_orderdate").alias("recorded_at"), F.col("o_totalprice").alias("depth_m"))


@query(f"WITH {VIDEOS} SELECT dive, count(*) AS videos, max(depth_m) AS max_depth_m FROM videos GROUP BY dive")
def dive_list(spark, sf_dir):
    return sel.dives(_videos(spark, sf_dir))


_SPREAD = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) - 1 AS i, count(*) OVER (PARTITION BY {by}) AS n FROM {src}) WHERE n <= {m} OR i IN (SELECT CAST(least(n - 1, floor(k * (n / {m}::DOUBLE))) AS BIGINT) FROM range({m}) q(k))"""


@query(f"WITH {VIDEOS} SELECT url, dive FROM ({_SPREAD.format(by='dive', order='url', src='videos', m=5)})")
def even_spread(spark, sf_dir):
    """The feature is a choice of five recordings a dive."""
    return sel.spread(_videos(spark, sf_dir), 5, ["dive"], ["url"]).select("url", "dive")


@query(f"""WITH {VIDEOS}, deep AS (SELECT dive, row_number() OVER (ORDER BY max(depth_m) DESC, dive) AS rank FROM videos GROUP BY dive), near AS (SELECT v.*, rank FROM videos v JOIN deep d ON d.dive = v.dive WHERE rank <= 8),
picked AS (SELECT url, dive, rank FROM ({_SPREAD.format(by='dive', order='url', src='near', m=7)})) SELECT url, dive FROM ({_SPREAD.format(by='1', order='rank, url', src='picked', m=30)})""")
def chosen_recordings(spark, sf_dir):
    """The feature is a choice: eight dives, seven recordings each, thirty in all."""
    return sel.choose(_videos(spark, sf_dir), 8, 7, 30).select("url", "dive")


@query(f"""WITH {VIDEOS}, win AS (SELECT s_suppkey AS dive, TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey*41 % 2000 AS INT)) AS start, TIMESTAMP '1992-01-01' + to_days(CAST(s_suppkey*41 % 2000 + CASE WHEN s_suppkey % 5 = 0 THEN -1 ELSE 300 END AS INT)) AS stop FROM supplier WHERE s_acctbal > 0)
SELECT url, dive FROM (SELECT *, sum(CASE WHEN inside THEN 1 ELSE 0 END) OVER (PARTITION BY dive) AS n FROM (SELECT v.*, start IS NULL OR recorded_at BETWEEN start AND stop AS inside FROM videos v LEFT JOIN win ON win.dive = v.dive)) WHERE inside OR n = 0""")
def on_the_bottom(spark, sf_dir):
    day = lambda n: F.expr(f"timestamp_ntz'1992-01-01' + make_dt_interval(cast({n} as int))")
    w = read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("dive"), day("s_suppkey*41 % 2000").alias("start"), day("s_suppkey*41 % 2000 + case when s_suppkey % 5 = 0 then -1 else 300 end").alias("stop"))
    return sel.on_the_bottom(_videos(spark, sf_dir), w).select("url", "dive")
