"""Vector bin packing of training examples by the dot-product heuristic.

A sequence has three capacities: tokens, segments and loss-bearing tokens.  The open sequence
takes, of the waiting pieces that fit in all three, the one whose demand vector has the largest
weighted dot product with what is left; a dimension's weight is its mean demand.  Divisible
pieces (plain documents) may be cut once nothing fits, so that the sequence closes full;
indivisible ones (instruction conversations) never are.

Every task packs its own input partition in one pass with a bounded pool of waiting pieces: no
shuffle, no group, and at most one part-filled sequence a task.  sequence_id is the task's
partition number and a counter, so a task that is run again gives the same rows as long as its
input partition is stable (a table scan is; write anything else to a table first).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ship
from .tokens import WordIds, cached


class Limits(NamedTuple):
    tokens: int = 2048
    segments: int = 512
    loss: int = 2048


#: Pieces that wait in a task at most.
POOL = 512
#: The id that ends each document.
END = np.array([1], "<u4").tobytes()


class Piece(NamedTuple):
    key: object
    start: int
    length: int
    loss: int
    body: bytes


class Packer:
    """The pool of one task; sequences come out closed."""

    def __init__(self, limits: Limits, divisible: bool, pool: int = POOL):
        self.cap = np.array(limits, float)
        self.divisible = divisible
        self.most = pool
        self.need = np.zeros((pool + 1, 3))
        self.what: list[Piece] = []

    def add(self, p: Piece) -> Iterator[list[Piece]]:
        self.need[len(self.what)] = (p.length, 1, p.loss)
        self.what.append(p)
        while len(self.what) > self.most:
            yield self.close()

    def rest(self) -> Iterator[list[Piece]]:
        while self.what:
            yield self.close()

    def _take(self, k: int) -> Piece:
        p, last = self.what[k], len(self.what) - 1
        self.what[k] = self.what[last]
        self.need[k] = self.need[last]
        self.what.pop()
        return p

    def close(self) -> list[Piece]:
        """Fill one sequence from the pool."""
        left, out = self.cap.copy(), []
        weight = self.need[: len(self.what)].mean(0) / self.cap**3
        while self.what:
            need = self.need[: len(self.what)]
            score = np.where((need <= left).all(1), need @ (weight * left), -1.0)
            k = int(score.argmax())
            if score[k] < 0:
                break
            out.append(self._take(k))
            left -= (out[-1].length, 1, out[-1].loss)
        if self.divisible and self.what and left.min() >= 1:
            room = int(min(left[0], left[2]))
            k = int((self.need[: len(self.what)] @ (weight * left)).argmax())
            p = self.what[k]
            out.append(Piece(p.key, p.start, room, room, p.body[: 4 * room]))
            self.what[k] = Piece(p.key, p.start + room, p.length - room, p.loss - room, p.body[4 * room :])
            self.need[k] = (p.length - room, 1, p.loss - room)
        if not out:  # larger than any sequence by itself: alone, never dropped
            out.append(self._take(0))
        return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", where: str | None = None) -> DataFrame:
    """Pieces of all documents: PIECES, `ids` being a piece's token ids (little-endian uint32).

    Every id of every document, and the end id after it, lies in exactly one piece; a null or
    empty text is the end id alone; repeated rows are packed as often as they occur; a null
    doc_id stays null; an empty table gives an empty result.  All tokens bear loss.
    """
    ship(docs.sparkSession)
    whole = min(limits.tokens, limits.loss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds("word_bpe_49k.json", where)
        packer = Packer(limits, True)
        seq = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def put(pieces: list[Piece]) -> None:
            nonlocal seq
            at = 0
            for p in pieces:
                rows.append((p.key[0], p.start, p.length, p.body, p.key[1], seq, at))
                at += p.length
            seq += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW, strict=True)], names=_NAMES)

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), words.encode_all(b.column(1).to_pylist()), strict=True):
                ids += END
                n = len(ids) // 4
                for s in range(0, n, whole):
                    length = min(whole, n - s)
                    p = Piece((doc_id, n), s, length, length, ids[4 * s : 4 * (s + length)])
                    if length == limits.tokens:
                        put([p])
                    else:
                        for closed in packer.add(p):
                            put(closed)
                if len(rows) >= 2048:
                    yield flush()
        for closed in packer.rest():
            put(closed)
        if rows:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def pack_examples(examples: DataFrame, limits: Limits, key_col: str, tokens_col: str, loss_col: str) -> DataFrame:
    """Indivisible examples (key, tokens, loss) -> (key, sequence_id, offset, tokens, loss).

    An example beyond a limit has a sequence to itself; null counts are zero; keys keep their type.
    """
    ship(examples.sparkSession)
    src = examples.select(F.col(key_col).alias("key"), F.coalesce(F.col(tokens_col), F.lit(0)).cast("long").alias("tokens"), F.coalesce(F.col(loss_col), F.lit(0)).cast("long").alias("loss"))
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, False)
        seq = TaskContext.get().partitionId() << 33
        key_type = None

        def batch(closed: list[Piece]) -> pa.RecordBatch:
            nonlocal seq
            at = np.cumsum([0, *(p.length for p in closed)])[:-1]
            n = len(closed)
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([p.key for p in closed], key_type), pa.array([seq - 1] * n, pa.int64()), pa.array(at, pa.int64()), pa.array([p.length for p in closed], pa.int64()), pa.array([p.loss for p in closed], pa.int64())], names=["key", "sequence_id", "offset", "tokens", "loss"])

        for b in batches:
            key_type = b.schema.field(0).type
            for key, n, loss in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for closed in packer.add(Piece(key, 0, n, loss, b"")):
                    yield batch(closed)
        for closed in packer.rest():
            yield batch(closed)

    return src.mapInArrow(run, f"key {kind}, sequence_id long, offset long, tokens long, loss long")


def conversation_sizes(turns: DataFrame, key_col: str = "conv_id", role_col: str = "role", text_col: str = "text", where: str | None = None) -> DataFrame:
    """Turns -> (conv_id, tokens, loss) of each conversation; the assistant's tokens bear loss.

    Tokens are the tokenizer's; an empty or null turn has none.  A null key is one conversation; a null
    role bears no loss; repeated rows count as often as they occur; an empty table gives an empty result.
    """
    ship(turns.sparkSession)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([len(x) // 4 for x in cached(WordIds, "word_bpe_49k.json", where).encode_all(list(texts))], dtype="int64")

    n = F.pandas_udf(run, "long")(F.col(text_col).cast("string"))
    sized = turns.select(F.col(key_col).alias("conv_id"), F.col(role_col).alias("role"), n.alias("n"))
    return sized.groupBy("conv_id").agg(F.sum("n").alias("tokens"), F.sum(F.when(F.col("role") == "assistant", F.col("n")).otherwise(0)).alias("loss"))
