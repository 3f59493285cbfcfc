"""Token-count rollups that signed deltas keep up to date.

A change row inserts, deletes or revises the token count of one document under one tokenizer
version.  A batch of changes becomes signed subtotals by (source, lang, tokenizer), is written beside
the ledger in the shared folder and moved in under its id by one rename, which fails if the id is there:
of two writers one commits, and a retried or replayed batch changes nothing.

Totals are maintained: compact() adds the batches since the last snapshot to it, in a new snapshot
with the ids that it covers, moved in the same way; then the covered batches' files go.  Totals read
one snapshot and what came after it, from one listing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ship
from .tokens import WordIds, byte_bpe, cached

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
VERSIONS = ("word_bpe_49k", "byte_bpe_50k")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", where: str | None = None) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, n_bytes): a row for each document and version.

    Null texts have no tokens; null sources and languages stay null; repeated rows count twice.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, enc = WordIds("word_bpe_49k.json", where), cached(byte_bpe, "byte_bpe_50k.tiktoken", where)
        for b in batches:
            texts = [t or "" for t in b["text"]]
            by = ([len(x) // 4 for x in words.encode_all(texts)], [len(enc.encode_ordinary(t)) for t in texts])
            size = [len(t.encode()) for t in texts]
            for version, n in zip(VERSIONS, by, strict=True):
                yield b[["doc_id", "source", "lang"]].astype({"doc_id": "Int64"}).assign(tokenizer=version, n_tokens=n, n_bytes=size)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return src.mapInPandas(run, "doc_id long, source string, lang string, tokenizer string, n_tokens long, n_bytes long")


def changes(rows: DataFrame, op: str, n: str | None = None, old: str | None = None) -> DataFrame:
    """Change rows of one kind: `n` names the new count (insert, revise), `old` the one it replaces (delete, revise)."""
    none = F.lit(None).cast("long")
    return rows.select(F.lit(op).alias("op"), *KEYS, (F.col(n) if n else none).alias("n_tokens"), (F.col(old) if old else none).alias("old_tokens"))


def signed(change: DataFrame) -> DataFrame:
    """Change rows (op, keys, n_tokens, old_tokens) -> signed subtotals by key, partially summed first.

    Null counts are zero; an op that isn't insert, delete or revise adds nothing.
    """
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    tokens = F.when(F.col("op") == "insert", new).when(F.col("op") == "delete", -old).when(F.col("op") == "revise", new - old).otherwise(0)
    return change.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))


class Ledger:
    """Committed batches and snapshots under one folder that all executors share.

    A writer that dies leaves nothing but a folder whose name starts with a dot, which nobody reads.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        fs = self._fs()
        if not fs.exists(self._path()):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(self._path()))
        return [n.removeprefix(kind) for n in names if n.startswith(kind)]

    def _move(self, tmp: str, name: str) -> bool:
        """Give a written folder its name; False, and the folder goes, if there is one of that name."""
        jvm = self.spark.sparkContext._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path().toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(self._path(tmp), self._path(name), self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception) and not self._fs().exists(self._path(name)):
                raise
            self._fs().delete(self._path(tmp), True)
            return False
        return True

    def _snapshot(self) -> int:
        """Number of the last snapshot, 0 if there is none."""
        return max(map(int, self._names("snapshot=")), default=0)

    def _covered(self, snapshot: int, batches: list[str]) -> set[str]:
        """Those of these ids that the snapshot covers."""
        if not snapshot or not batches:
            return set()
        ids = self.spark.read.schema("batch string").parquet(f"{self.path}/snapshot={snapshot}/batches")
        asked = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        return {r["batch"] for r in ids.join(F.broadcast(asked), "batch", "left_semi").collect()}

    def committed(self, batch_id: str) -> bool:
        return self._fs().exists(self._path(f"batch={batch_id}")) or bool(self._covered(self._snapshot(), [batch_id]))

    def commit(self, batch_id: str, change: DataFrame) -> bool:
        """Add a batch once. False if its id was there."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
            raise ValueError(f"a batch id has letters, digits, dots, dashes and underscores: {batch_id!r}")
        if self.committed(batch_id):
            return False
        tmp = f".try-{uuid.uuid4().hex}"
        signed(change).where("docs <> 0 or tokens <> 0").coalesce(1).write.parquet(f"{self.path}/{tmp}")
        return self._move(tmp, f"batch={batch_id}")

    def batches(self) -> list[str]:
        """Ids of the batches that no snapshot covers."""
        here = self._names("batch=")
        gone = self._covered(self._snapshot(), here)
        return [b for b in here if b not in gone]

    def _rows(self, snapshot: int, batches: list[str]) -> DataFrame:
        paths = [f"{self.path}/batch={b}" for b in batches] + [f"{self.path}/snapshot={snapshot}/totals"] * (snapshot > 0)
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over the committed batches; keys without documents and tokens go."""
        rows = self._rows(self._snapshot(), self.batches())
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def compact(self) -> bool:
        """Take the batches since the last snapshot into a new one. False if there are none, or another writer was first."""
        last, batches = self._snapshot(), self.batches()
        if not batches:
            return False
        tmp = f".try-{uuid.uuid4().hex}"
        totals = self._rows(last, batches).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
        totals.coalesce(1).write.parquet(f"{self.path}/{tmp}/totals")
        ids = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        if last:
            ids = ids.union(self.spark.read.schema("batch string").parquet(f"{self.path}/snapshot={last}/batches"))
        ids.coalesce(1).write.parquet(f"{self.path}/{tmp}/batches")
        if not self._move(tmp, f"snapshot={last + 1}"):
            return False
        for name in [f"batch={b}" for b in batches] + [f"snapshot={last}"] * (last > 0):
            self._fs().delete(self._path(name), True)
        return True

    def drop(self) -> None:
        self._fs().delete(self._path(), True)
