import math
from collections import Counter

import numpy as np

from benthos.llm import lm


def brute(docs, target):
    """The bigram models restated with dictionaries."""
    vocab = {w for _, t in docs for w in lm.tokens(t)}
    models = []
    for ids in (target, None):
        one, two = Counter(), Counter()
        for i, t in docs:
            if ids is None or i in ids:
                w = lm.tokens(t)
                one.update(w)
                two.update(zip([None, *w], w))
                one[None] += bool(w)
        models.append((one, two, sum(one.values()) - one[None]))
    out = []
    for i, t in docs:
        w = lm.tokens(t)
        losses = []
        for one, two, n in models:
            p = lambda a, b: (two[a, b] + lm.PRIOR * (one[b] + 1) / (n + len(vocab) + 1)) / (one[a] + lm.PRIOR)  # noqa: B023, E731
            losses.append(sum(-math.log(p(a, b)) for a, b in zip([None, *w], w)) / len(w) if w else 0.0)
        out.append((i, len(w), *losses))
    return out


def near(got, want):
    key = lambda r: (str(r[0]), r[1:])
    got, want = sorted((tuple(r)[:4] for r in got), key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want], atol=1e-9)


def test_matches_a_restatement_for_any_chunks(spark):
    docs = [(i, " ".join(f"w{(i * k * k + k) % 17}" for k in range(i % 23))) for i in range(60)] + [(50, None), (51, ""), (52, "Zz zZ \u00e9!"), (None, "w1 w2 w3"), (3, "w1 w2 w3"), (3, "w1 w2 w3")]
    target = {i for i, _ in docs if i is not None and i % 3 == 0}
    ids = spark.createDataFrame([(i,) for i in target] + [(None,)], "doc_id long")
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as hit", "2 as n", "3 as chunk")
    for rows, chunk, share in ((d, lm.CHUNK, lm.RANGE), (d, 100, 30), (d.repartition(5, "text"), 1, 500)):
        near(lm.score(rows, ids, chunk=chunk, share=share).collect(), brute(docs, target))


def test_a_word_pair_in_most_of_the_rows_and_a_very_long_text(spark):
    docs = [(i, "same pair " * 20 + f"own{i}") for i in range(200)] + [(900, " ".join(f"x{k % 977}" for k in range(60_000)))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    near(lm.score(d, spark.createDataFrame([(i,) for i in range(50)], "doc_id long"), chunk=5000, share=20_000).collect(), brute(docs, set(range(50))))


def test_the_target_scores_lower(spark):
    rng = np.random.default_rng(1)
    docs = [(i, " ".join(f"{'t' if i % 2 else 'b'}{rng.integers(30)}" for _ in range(50))) for i in range(200)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i, _ in docs if i % 2 and i < 150], "doc_id long")
    out = {r["doc_id"]: r["difference"] for r in lm.score(d, ids).collect()}
    assert max(v for i, v in out.items() if i % 2) < min(v for i, v in out.items() if not i % 2)


def test_edges(spark):
    d = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    out = lm.score(d, spark.createDataFrame([], "doc_id long")).collect()
    assert len(out) == 4 and all(np.isfinite(r["difference"]) for r in out)
    assert lm.score(d.limit(0), spark.createDataFrame([], "doc_id long")).count() == 0
    assert lm.score(d.where("text is null"), spark.createDataFrame([(2,)], "doc_id long")).collect()[0][1:] == (0, 0.0, 0.0, 0.0)
