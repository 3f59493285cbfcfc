"""Toxicity as cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(x.w - theta_k): one weight vector is shared by all ordered thresholds.
Features are the presence of words and of their first letters; they are screened on a bounded labelled sample and the fit is
L1-penalised with a penalty in proportion to each feature's chance deviation, so long clean documents
gather no weight; what survives is fitted again with a small ridge only.  The labels hold no grades, only toxic 0/1, so a first, binary fit of the same model
orders the toxic rows by evidence and their thirds become grades 1 to 3.

Only the fit uses a sample (MAX_LABELLED rows by hash order); every document is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ship, stored

#: Labelled rows that the fit reads at most (a documented bound), and words that pass the screen.
MAX_LABELLED, MAX_WORDS = 20_000, 4096
#: Chance deviations that a feature's association must exceed to have weight, and the ridge of the refit.
PENALTY, RIDGE = 4.5, 0.05
GRADES = 3
_WORD = re.compile(r"\w+")


def terms(text: str | None) -> tuple[set[str], ...]:
    """A text's features by kind: words, and their first four and five letters (word stems)."""
    words = set(_WORD.findall(text.lower())) if text else set()
    return words, {w[:4] for w in words}, {w[:5] for w in words}


class Model(NamedTuple):
    weights: tuple[dict[str, float], ...]
    thresholds: tuple[float, ...]

    def tails(self, text: str | None) -> list[float]:
        """P(grade > k) for each k."""
        eta = sum(sum(map(w.__getitem__, sorted(t & w.keys()))) for w, t in zip(self.weights, terms(text), strict=False))
        return [float(1 / (1 + np.exp(np.clip(t - eta, -60, 60)))) for t in self.thresholds]


def fit_ordinal(rows: list[np.ndarray], grade: np.ndarray, n_words: int, grades: int, rounds: int = 400, penalty: float = PENALTY, ridge: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by accelerated proximal gradient with a diagonal bound."""
    n = len(rows)
    idx = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    of = np.repeat(np.arange(n), [len(r) for r in rows])
    df = np.bincount(idx, minlength=n_words)
    share = float((grade > 0).mean())
    l1 = penalty * np.sqrt(np.maximum(df, 1) * share * (1 - share))
    bound = 0.25 * grades * np.bincount(idx, np.bincount(of, minlength=n)[of] + 1.0, n_words) + 1e-6 + ridge
    above = np.array([((grade > k).mean() * n + 0.5) / (n + 1) for k in range(grades)])
    theta = np.sort(-np.log(above / (1 - above)))
    w, v, s = np.zeros(n_words), np.zeros(n_words), 1.0
    vt = theta.copy()
    yk = (grade[:, None] > np.arange(grades)).astype(float)
    for _ in range(rounds):
        eta = np.bincount(of, v[idx], n)
        r = 1 / (1 + np.exp(np.clip(vt - eta[:, None], -40, 40))) - yk  # d loss / d eta, a column for each threshold
        step = v - (np.bincount(idx, r.sum(1)[of], n_words) + ridge * v) / bound
        new = np.sign(step) * np.maximum(np.abs(step) - l1 / bound, 0)
        newt = np.maximum.accumulate(vt + r.sum(0) / (0.25 * n))
        s2 = (1 + np.sqrt(1 + 4 * s * s)) / 2
        if ((new - w) * (v - new)).sum() > 0:  # restart when the momentum points uphill
            s2 = 1.0
        v, vt = new + (s - 1) / s2 * (new - w), np.maximum.accumulate(newt + (s - 1) / s2 * (newt - theta))
        w, theta, s = new, newt, s2
    return w, theta


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MAX_LABELLED) -> Model:
    """The model from labelled documents; null labels and ids are left out, a doc labelled twice takes its worst label,
    an id of several rows counts with one of its texts.

    With no toxic or no clean label the model has no words and rejects nothing.
    """
    ship(docs.sparkSession)
    some = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("_id is not null and y is not null").groupBy("_id").agg(F.max("y").alias("y"))
    some = stored(some.orderBy(F.xxhash64("_id"), "_id").limit(most), "labelled")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 500):  # words take many times the room of their text
                part = b.iloc[i : i + 500]
                yield pd.DataFrame({"y": part["y"], "words": [[f"{k}{w}" for k, ws in enumerate(terms(t)) for w in sorted(ws)] for t in part["text"]]})

    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(some), "_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "y", "text")).alias("r")  # an id of several rows has one here, so the bound holds
    rows = stored(found.groupBy("_id").agg(one).select("r.y", "r.text").mapInPandas(split, "y int, words array<string>"), "words")
    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < bad < n:
        return Model((), (60.0,) * GRADES)
    due = F.col("df") * (bad / n)
    counts = rows.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"), F.sum("y").alias("bad")).where("df > 2")
    top = counts.withColumn("z", F.abs(F.col("bad") - due) / F.sqrt(due * (1 - bad / n))).orderBy(F.desc("z"), "word").limit(MAX_WORDS)
    vocab = {r["word"]: i for i, r in enumerate(top.collect())}

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "ids": [sorted(vocab[w] for w in ws if w in vocab) for ws in b["words"]]})

    got = rows.mapInPandas(pick, "y int, ids array<int>").toArrow().to_pandas()
    got = got.assign(k=got["ids"].map(lambda v: tuple(v))).sort_values(["y", "k"], kind="stable")
    x, y = [np.asarray(v, np.int64) for v in got["ids"]], (got["y"].to_numpy() > 0).astype(int)
    w, _ = fit_ordinal(x, y, len(vocab), 1)
    x = [r[w[r] != 0] for r in x]  # what survives the penalty is fitted again without it
    w, _ = fit_ordinal(x, y, len(vocab), 1, penalty=0.0, ridge=RIDGE)
    eta = np.array([w[r].sum() for r in x])
    cut = np.quantile(eta[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 1, 1 + np.searchsorted(cut, eta, side="left"), 0)
    w, theta = fit_ordinal(x, grade, len(vocab), GRADES, penalty=0.0, ridge=RIDGE)
    return Model(tuple({word[1:]: float(w[i]) for word, i in vocab.items() if w[i] and word[0] == str(k)} for k in range(3)), tuple(map(float, theta)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", reject: float = 0.5) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, rejected) of every row: the expected grade, P(grade > 0), the
    median grade, and p_toxic >= reject.  A null or empty text has no words; repeated rows score alike.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t = [model.tails(x) for x in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "severity": [sum(x) for x in t], "p_toxic": [x[0] for x in t], "grade": [sum(p >= 0.5 for p in x) for x in t], "rejected": [x[0] >= reject for x in t]})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, "doc_id long, severity double, p_toxic double, grade int, rejected boolean")


def clean(docs: DataFrame, model: Model, text_col: str = "text", reject: float = 0.5) -> DataFrame:
    """The rows that the model doesn't reject, with all their columns."""
    ship(docs.sparkSession)
    rejected = F.pandas_udf(lambda s: pd.Series([model.tails(t)[0] >= reject for t in s], dtype=bool), "boolean")
    return docs.where(~rejected(F.col(text_col).cast("string")))
