"""Cross-entropy difference: matched target and background bigram models over one vocabulary.

The vocabulary is every word of the documents.  Both models are word bigrams with the same smoothing,

    p(w | h) = (c(h, w) + PRIOR p(w)) / (c(h) + PRIOR),   p(w) = (c(w) + 1) / (N + V + 1),

where the background counts all documents and the target those of the target domain; a document's
first word follows START and c(h) holds the occurrences that end a document.  A document's score is
the mean over its tokens of target loss less background loss (lower is more like the target).

Counts are exact and nothing of them is cut, hashed into classes, collected or broadcast, so what the
scoring gathers grows with the corpus:

1. A chunk is about CHUNK characters of neighbouring documents of one input partition.  It sends each
   of its distinct words and bigrams once, as a 64-bit key with the chunk's own counts, sorted and
   sliced by key range; a word pair that holds a third of the corpus is one key of each chunk.
2. A key range adds up the counts of its keys and answers each slice with what the other chunks have
   of the same keys, in the same order.  There are more ranges in proportion to the corpus.
3. The documents of a chunk meet its answers and are scored.

The chunks are numbered alike both times that the documents are read, so the input must be a stable
scan; anything with a shuffle in it is written to a table first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Stored, ship, stored

#: Weight of the unigram in the bigram's smoothing, and target ids that may be broadcast.
PRIOR, BROADCAST_IDS = 5.0, 2_000_000
#: Characters of a chunk, characters of the corpus for each key range, and words that a task remembers.
CHUNK, RANGE, CACHE = 1 << 23, 1 << 23, 500_000
START = np.uint64(0x5BD1E9955BD1E995)
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Keys(dict):
    """word -> 64-bit key."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return out

    def of(self, text: str | None) -> np.ndarray:
        words = tokens(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (before ^ (before >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29)) ^ word) * _MIX
    return x ^ (x >> np.uint64(32))


class Chunk(NamedTuple):
    """Documents by their words' keys."""

    sizes: np.ndarray  # tokens of each document
    words: np.ndarray  # words, then START for each document that has any
    pairs: np.ndarray
    hit: np.ndarray  # of each entry of words: in the target

    @classmethod
    def of(cls, docs: list[np.ndarray], hits: list[bool]) -> Chunk:
        sizes = np.array([len(d) for d in docs], np.int64)
        words = np.concatenate([*docs, np.zeros(0, np.uint64)])
        some = sizes > 0
        first = (np.cumsum(sizes) - sizes)[some]
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[first] = START
        hits = np.array(hits, bool)
        return cls(sizes, np.append(words, np.full(len(first), START, np.uint64)), pair_keys(before, words), np.append(np.repeat(hits, sizes), hits[some]))

    def counted(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For words and for pairs: distinct keys ascending, the place of each entry, its counts in all and in the target."""
        out = []
        for keys in (self.words, self.pairs):
            own, at = np.unique(keys, return_inverse=True)
            out.append((own, at, np.bincount(at, minlength=len(own)), np.bincount(at[self.hit[: len(at)]], minlength=len(own))))
        return out


class Totals(NamedTuple):
    """Tokens of all and of the target's documents, and distinct words."""

    n: int
    t: int
    vocab: int

    def losses(self, c: Chunk, counts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Mean losses (target, background) of each document of the chunk, given the corpus's counts of its keys."""
        (_, word, wn, wt), (_, pair, pn, pt) = counts
        m = len(pair)
        some = c.sizes > 0
        before = np.empty(m, np.int64)
        before[1:] = word[: m - 1]
        first = (np.cumsum(c.sizes) - c.sizes)[some]
        before[first] = word[m:]
        word = word[:m]
        out = np.zeros((len(c.sizes), 2))
        for k, (total, w, p) in enumerate(((self.t, wt, pt), (self.n, wn, pn))):
            one = (w[word] + 1) / (total + self.vocab + 1)
            loss = -np.log((p[pair] + PRIOR * one) / (w[before] + PRIOR))
            if m:
                out[some, k] = np.add.reduceat(loss, first) / c.sizes[some]
        return out


def _numbers(texts: pa.Array, before: int, chunk: int) -> tuple[np.ndarray, int]:
    """The chunk (in its partition) of each text, and the characters so far."""
    size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = before + np.cumsum(size)
    return (upto - size) // chunk, int(upto[-1]) if len(upto) else before


def _slices(bits: int, size: int):
    """Documents -> (bucket, chunk, keys, n, t): each chunk's distinct keys by range, words in the first half of the buckets."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def sliced(chunk: int, docs: list, hits: list) -> pa.RecordBatch:
        rows = []
        for kind, (own, _, n, t) in enumerate(Chunk.of(docs, hits).counted()):
            cuts = np.append(np.searchsorted(own, edges), len(own))
            for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if x < y:
                    rows.append((kind << bits | b, chunk, own[x:y].tobytes(), n[x:y].astype("<i4").tobytes(), t[x:y].astype("<i4").tobytes()))
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "keys", "n", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, here, chars, now = Keys(), TaskContext.get().partitionId() << 32, 0, 0
        docs, hits = [], []
        for b in batches:
            numbers, chars = _numbers(b.column("text"), chars, size)
            for k, text, hit in zip(numbers.tolist(), b.column("text").to_pylist(), b.column("hit").to_pylist(), strict=True):
                if k != now and docs:
                    yield sliced(here + now, docs, hits)
                    docs, hits = [], []
                now = k
                docs.append(keys.of(text))
                hits.append(hit)
        if docs:
            yield sliced(here + now, docs, hits)

    return run


def _answers(words: int):
    """One key range's slices -> (chunk, bucket, n, t: what the other chunks have, vocab, tokens, target)."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint64) for k in g["keys"]]
        n, t = (np.concatenate([np.frombuffer(x, "<i4") for x in g[c]]).astype(np.int64) for c in ("n", "t"))
        cuts = np.cumsum([0, *map(len, keys)])
        all_keys = np.concatenate(keys)
        own, at = np.unique(all_keys, return_inverse=True)
        more = [np.bincount(at, x, len(own)).astype(np.int64)[at] - x for x in (n, t)]
        out = pd.DataFrame({"chunk": g["chunk"].to_numpy(), "bucket": g["bucket"].to_numpy(), "vocab": 0, "tokens": 0, "target": 0})
        out["n"], out["t"] = ([x[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)] for x in more)
        if int(g["bucket"].iat[0]) < words:
            real = all_keys != START
            out.loc[0, ["vocab", "tokens", "target"]] = [int((own != START).sum()), int(n[real].sum()), int(t[real].sum())]
        return out[["chunk", "bucket", "n", "t", "vocab", "tokens", "target"]]

    return run


def _placed(size: int):
    """Documents with their chunk and place in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, chars, at = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            numbers, chars = _numbers(b.column("text"), chars, size)
            place = pa.array(np.arange(at, at + len(b), dtype=np.int64))
            at += len(b)
            yield pa.RecordBatch.from_arrays([pa.array(here + numbers), place, *(b.column(c) for c in ("doc_id", "hit", "text"))], names=["chunk", "place", "doc_id", "hit", "text"])

    return run


def _scored(totals: Totals):
    """Each chunk's answers (place below 0) and then its documents -> scores."""

    def scores(ids: list, docs: list, hits: list, n: list, t: list) -> pa.RecordBatch:
        c = Chunk.of(docs, hits)
        counts, upto = [], 0
        n, t = (np.frombuffer(b"".join(x), "<i8") for x in (n, t))
        for own, at, own_n, own_t in c.counted():
            part = slice(upto, upto := upto + len(own))
            counts.append((own, at, own_n + n[part], own_t + t[part]))
        loss = totals.losses(c, counts)
        cols = (ids, c.sizes, loss[:, 0], loss[:, 1], loss[:, 0] - loss[:, 1])
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_tokens", "loss_target", "loss_background", "difference"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, now = Keys(), None
        ids, docs, hits, n, t = [], [], [], [], []
        for b in batches:
            for chunk, place, doc_id, hit, text, more_n, more_t in zip(*(b.column(c).to_pylist() for c in ("chunk", "place", "doc_id", "hit", "text", "n", "t")), strict=True):
                if chunk != now:
                    if ids:
                        yield scores(ids, docs, hits, n, t)
                    ids, docs, hits, n, t, now = [], [], [], [], [], chunk
                if place < 0:
                    n.append(more_n)
                    t.append(more_t)
                else:
                    ids.append(doc_id)
                    docs.append(keys.of(text))
                    hits.append(hit)
        if ids:
            yield scores(ids, docs, hits, n, t)

    return run


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, share: int = RANGE) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, difference) of every row, in nats a token.

    The models count every row of `docs`, the target's those whose id is among the first column of
    `target_ids`.  A null or wordless text counts nothing and scores zeros; a null id is never in the
    target; repeated rows count as often as they occur and score alike; an empty table gives an empty
    result.
    """
    ship(docs.sparkSession)
    ids = stored(target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("_t")).where("_t is not null").distinct(), "target")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    few = ids.count() <= BROADCAST_IDS
    marked = src.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_t"), "left").select("doc_id", "text", F.col("_t").isNotNull().alias("hit"))
    if not few or "Exchange" in src._jdf.queryExecution().executedPlan().toString():
        marked = stored(marked, "marked")

    chars = src.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(1, int(np.ceil(np.log2(max(2, chars / share)))))
    slices = marked.select("text", "hit").mapInArrow(_slices(bits, chunk), "bucket int, chunk long, keys binary, n binary, t binary")
    answers = Stored(slices.groupBy("bucket").applyInPandas(_answers(1 << bits), "chunk long, bucket int, n binary, t binary, vocab long, tokens long, target long"), "answers").read()
    sums = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "target", "vocab"))).first()

    none = F.lit(None).cast("binary")
    rows = marked.mapInArrow(_placed(chunk), "chunk long, place long, doc_id long, hit boolean, text string").select("*", none.alias("n"), none.alias("t"))
    asked = answers.select("chunk", (F.col("bucket") - (2 << bits)).cast("long").alias("place"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("hit"), F.lit(None).cast("string").alias("text"), "n", "t")
    both = rows.union(asked).repartition("chunk").sortWithinPartitions("chunk", "place")
    return both.mapInArrow(_scored(Totals(*sums)), "doc_id long, n_tokens long, loss_target double, loss_background double, difference double")
