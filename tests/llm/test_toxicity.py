import math
import random

import numpy as np

from benthos.llm import toxicity


def corpus(n, seed, bad=("moron", "scum", "vequal", "vequir", "vequon")):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.15)
        w = [rng.choice(words) for _ in range(rng.choice([5, 30, 300]))]
        for _ in range(rng.randint(1, 6) if y else 0):
            w.insert(rng.randint(0, len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), y))
    return rows


def test_held_out_accuracy_and_expected_severity(spark):
    train, test = corpus(1500, 1), corpus(600, 2, ("moron", "scum", "vequet"))  # an ending never seen
    d = spark.createDataFrame([r[:2] for r in train], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in train] + [(0, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    m = toxicity.fit(d, labels)
    out = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(test, "doc_id long, text string, severity int"), m).collect()}
    right = [out[i]["rejected"] == bool(y) for i, _, y in test]
    assert np.mean(right) > 0.98 and not any(out[i]["rejected"] for i, _, y in test if not y)
    n = lambda t: sum(w in ("moron", "scum") for w in t.split())
    low = [out[i]["severity"] for i, t, y in test if y and n(t) == 1]
    high = [out[i]["severity"] for i, t, y in test if y and n(t) >= 4]
    assert np.mean(high) > np.mean(low) > 0.5
    assert list(m.thresholds) == sorted(m.thresholds)
    assert all(a >= b for t in ("", "moron scum", "w1 w2") for a, b in zip(m.tails(t), m.tails(t)[1:]))


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(4)
    x = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(2000)]
    weight = np.array([2.0, 1.0, 0.0, 0.0, -1.0, 3.0])
    grade = np.array([int(np.searchsorted([1.0, 3.0, 4.5], weight[r].sum() + rng.logistic() * 0.3)) for r in x])
    w, theta = toxicity.fit_ordinal(x, grade, 6, 3, penalty=0.0, ridge=0.05)
    assert w[5] > w[0] > w[1] > abs(w[2]) + 0.3 > w[4] and theta[0] < theta[1] < theta[2]


def test_edges(spark):
    d = spark.createDataFrame([(1, None), (1, None), (None, ""), (3, "x " * 100_000)], "doc_id long, text string")
    none = toxicity.fit(d, spark.createDataFrame([], "doc_id long, toxic int"))
    out = toxicity.score(d, none).collect()
    assert len(out) == 4 and not any(r["rejected"] for r in out)
    assert toxicity.clean(d, none).count() == 4
    assert toxicity.score(d.limit(0), none).count() == 0


def test_the_fit_is_the_least_of_the_plain_objective():
    """Ordinal likelihood written out: at the fit, no small step in any weight or threshold lowers it."""
    rng = np.random.default_rng(3)
    n, words, grades = 300, 12, 3
    rows = [np.flatnonzero(rng.random(words) < 0.3) for _ in range(n)]
    true = rng.normal(size=words)
    eta = np.array([true[r].sum() for r in rows]) + rng.logistic(size=n)
    grade = np.searchsorted(np.quantile(eta, [0.5, 0.7, 0.9]), eta)

    def loss(w, theta, l1):
        total = 0.0
        for r, g in zip(rows, grade):
            x = sum(w[k] for k in r)
            for k in range(grades):
                p = 1 / (1 + math.exp(theta[k] - x))
                total -= math.log(p if g > k else 1 - p)
        return total + 0.05 / 2 * sum(v * v for v in w) + sum(a * abs(v) for a, v in zip(l1, w))

    for penalty in (0.0, 1.5):
        w, theta = toxicity.fit_ordinal(rows, grade, words, grades, rounds=4000, penalty=penalty, ridge=0.05)
        df, share = np.bincount(np.concatenate(rows), minlength=words), (grade > 0).mean()
        l1 = penalty * np.sqrt(np.maximum(df, 1) * share * (1 - share))
        best = loss(w, theta, l1)
        assert list(theta) == sorted(theta)
        for k in range(words + grades):
            for step in (-0.02, 0.02):
                a, b = w.copy(), theta.copy()
                if k < words:
                    a[k] += step
                else:
                    b[k - words] += step
                assert loss(a, b, l1) >= best - 1e-6


def test_tails_and_severity_are_the_plain_formula(spark):
    model = toxicity.Model(({"bad": 2.0}, {"evil": 1.5}, {}), (0.5, 1.0, 3.0))
    text = "A bad, Evilest thing"
    x = 2.0 + 1.5
    want = [1 / (1 + math.exp(t - x)) for t in model.thresholds]
    assert np.allclose(model.tails(text), want)
    r = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert abs(r["severity"] - sum(want)) < 1e-12 and r["grade"] == sum(p >= 0.5 for p in want) and r["rejected"]


def test_repeated_ids_stay_within_the_bound(spark):
    docs = [(i % 200, f"word{i} " + ("scum trash" if i % 2 else "flower")) for i in range(1000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, most=150)
    assert model.tails("scum trash")[0] > 0.5 > model.tails("flower")[0]
