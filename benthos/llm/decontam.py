"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed once; a k-gram hash covers GRAM words and each run of WINDOW words keeps its least
k-gram (the rightmost on ties), so every run of SPAN = GRAM + WINDOW - 1 words that a document shares
with an item selects the same k-gram in both.  Kept fingerprints (one for about 3.5 words) meet the
benchmark's by an equi-join; each hit is extended to the SPAN-word windows around it, which must be
equal to a benchmark window.  Items shorter than SPAN words are one window of their own length and
are looked for at every position, for the few lengths that occur.

Neither side's text is ever shuffled: only kept fingerprints that meet one leave the scan, as long
as the benchmark's fingerprints are few enough to broadcast (BROADCAST_ROWS, counted first); beyond
that the same join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Stored, stored, text_hash

GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
#: Benchmark fingerprints or windows that may be broadcast: 16 bytes each, so 32 MB at most.
BROADCAST_ROWS = 2_000_000
#: What separates words once A-Z count as a-z (fixed by the data contract).
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_WORD), "")


def word_hash(w: Column) -> Column:
    """Lower-cases A-Z only; `lower` does that for words without other letters, and faster."""
    return F.when(F.octet_length(w) == F.length(w), F.xxhash64(F.lower(w))).otherwise(F.xxhash64(F.translate(w, UPPER, LOWER)))


def _gram(col: str, n: int):
    return lambda i: F.xxhash64(*[F.get(F.col(col), i + k) for k in range(n)])


def _upto(n: Column, size: int) -> Column:
    """Start positions of runs of `size` among n; none as an empty array."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def hashed(df: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    """keep..., w (word hashes), n (their number)."""
    out = df.select(*keep, F.transform(words(F.col(text_col).cast("string")), word_hash).alias("w"))
    return out.withColumn("n", F.size("w"))


def kept_grams(df: DataFrame, *keep: str) -> DataFrame:
    """keep..., w, n, p, fp: the k-gram that each window keeps, where the choice changes."""
    grams = df.where(F.col("n") >= SPAN).select(*keep, "w", "n", F.transform(_upto(F.col("n"), GRAM), _gram("w", GRAM)).alias("g"))
    at = grams.select(*keep, "w", "n", "g", F.explode(F.sequence(F.lit(0), F.col("n") - SPAN)).alias("i"))

    def least(i: Column) -> Column:
        return F.least(*[F.get(F.col("g"), i + o).bitwiseAND(F.lit(-8).cast("long")).bitwiseOR(F.lit(WINDOW - 1 - o).cast("long")) for o in range(WINDOW)])

    here = at.withColumn("m", least(F.col("i"))).withColumn("before", F.when(F.col("i") > 0, least(F.col("i") - 1)))
    pos = lambda m, i: i + (WINDOW - 1) - m.bitwiseAND(F.lit(7).cast("long")).cast("int")
    here = here.withColumn("p", pos(F.col("m"), F.col("i")))
    changed = F.col("before").isNull() | (pos(F.col("before"), F.col("i") - 1) != F.col("p"))
    return here.where(changed).select(*keep, "w", "n", "p", F.shiftright("m", 3).alias("fp"))


def _few(df: DataFrame) -> bool:
    return df.count() <= BROADCAST_ROWS


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if _few(df) else df


def benchmark_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, len, h): every item's windows; an item of 1 to SPAN - 1 words is one window."""
    w = hashed(items, text_col, F.col(item_col).alias("item_id")).where("n > 0")
    long = w.where(F.col("n") >= SPAN).select("item_id", F.lit(SPAN).alias("len"), F.explode(F.transform(_upto(F.col("n"), SPAN), _gram("w", SPAN))).alias("h"))
    short = w.where(F.col("n") < SPAN).select("item_id", F.col("n").alias("len"), F.aggregate("w", F.lit(0).cast("long"), lambda s, x: F.xxhash64(s, x)).alias("h"))
    return long.union(short).distinct()


def hits(docs: DataFrame, items: DataFrame, windows: DataFrame, text_col: str = "text", item_text: str = "text") -> DataFrame:
    """docs with key columns _d, _k -> (_d, _k, s, len, h): window starts in documents, each once."""
    keys = ["_d", "_k"]
    own = hashed(docs, text_col, F.col("_d"), F.col("_k"))
    prints = stored(kept_grams(hashed(items, item_text)).select("fp").distinct(), "fp")
    known = stored(windows.select("len", "h").distinct(), "known")
    grams = kept_grams(own, *keys)
    if _few(prints):
        met = grams.join(F.broadcast(prints), "fp")
    else:  # only positions are shuffled; a document with any comes back to its words once
        at = grams.select(*keys, "p", "fp").join(prints, "fp").groupBy(F.col("_d").alias("d"), F.col("_k").alias("k")).agg(F.collect_set("p").alias("at"))
        met = own.join(at, F.col("_d").eqNullSafe(F.col("d")) & (F.col("_k") == F.col("k"))).select(*keys, "w", "n", F.explode("at").alias("p"))
    around = met.select(*keys, "w", F.explode(F.sequence(F.greatest(F.lit(0), F.col("p") - (WINDOW - 1)), F.least(F.col("p"), F.col("n") - SPAN))).alias("s"))
    found = around.select(*keys, "s", F.lit(SPAN).alias("len"), F.xxhash64(*[F.get("w", F.col("s") + k) for k in range(SPAN)]).alias("h")).distinct()
    out = found.join(_small(known.where(F.col("len") == SPAN)), ["len", "h"], "left_semi").select(*keys, "s", "len", "h")
    lens = sorted(r["len"] for r in known.where(F.col("len") < SPAN).select("len").distinct().collect())  # at most SPAN - 1 values
    if not lens:
        return out
    at = own.where(F.col("n") >= lens[0]).select(*keys, "w", "n", F.explode(F.sequence(F.lit(0), F.col("n") - lens[0])).alias("s"))
    h, runs = F.lit(0).cast("long"), []
    for size in range(1, lens[-1] + 1):
        h = F.xxhash64(h, F.get("w", F.col("s") + size - 1))
        if size in lens:
            runs.append(F.when(F.col("s") + size <= F.col("n"), F.struct(F.lit(size).alias("len"), h.alias("h"))))
    short = at.select(*keys, "s", F.explode(F.array(*runs)).alias("run")).where("run is not null").select(*keys, "s", "run.len", "run.h")
    return out.union(short.join(_small(known.where(F.col("len") < SPAN)), ["len", "h"], "left_semi").select(*keys, "s", "len", "h"))


def covered(spans: Column) -> Column:
    """Words inside any of the (s, len) runs of an array sorted by s."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    step = lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["s"] + x["len"] - F.greatest(x["s"], a["to"]))).alias("n"), F.greatest(a["to"], x["s"] + x["len"]).alias("to"))
    return F.aggregate(spans, start, step, lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) of every row of docs.

    `items` holds the ids of the items with occurring windows as strings, sorted.  A null or
    wordless text has no words and no hits; repeated rows come back as often as they went in; rows
    that share a doc_id but not a text keep their own results; null ids are carried; items with a null
    item_id count as one item, which is null and last in `items`; empty tables on either side give no hits.
    """
    return of_rows(docs, items, id_col, text_col, item_col, item_text).drop("text_hash")


def of_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """contamination with the hash of each row's text (base.text_hash) as text_hash."""
    src = docs.select(F.col(id_col).alias("_d"), F.col(text_col).cast("string").alias("_t")).withColumn("_k", text_hash("_t"))
    bench = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    windows = stored(benchmark_windows(bench), "windows")
    found = Stored(hits(src, bench, windows, "_t"), "hits").read()
    spans = found.groupBy("_d", "_k").agg(F.array_sort(F.collect_set(F.struct("s", "len"))).alias("spans"))
    named = found.select("_d", "_k", "len", "h").distinct().join(windows, ["len", "h"]).select("_d", "_k", "item_id").distinct()
    named = named.groupBy(F.col("_d").alias("d"), F.col("_k").alias("k")).agg(F.array_sort(F.transform(F.collect_list(F.struct("item_id")), lambda x: x["item_id"])).alias("items"))
    both = named.join(spans, F.col("_d").eqNullSafe(F.col("d")) & (F.col("_k") == F.col("k"))).select("d", "k", covered(F.col("spans")).cast("long").alias("n_hit"), "items")
    base = src.select("_d", "_k", F.size(words(F.col("_t"))).cast("long").alias("n_words"))
    out = base.join(both, base["_d"].eqNullSafe(both["d"]) & (base["_k"] == both["k"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("_d").alias(id_col), F.col("_k").alias("text_hash"), "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))
