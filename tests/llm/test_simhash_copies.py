import random

import numpy as np

import corpus_pipeline as cp
from benthos.llm import simhash_copies


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Least id of each row's group, by all pairs."""
    sets, comp = [grams(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or len(a & b) * 5 >= len(a | b) * 4:
                x, y = comp[i], comp[j]
                comp = [y if c == x else c for c in comp]
    return {rows[k][0]: min(rows[m][0] for m in range(len(rows)) if comp[m] == comp[k]) for k in range(len(rows))}


def corpus():
    """Texts with copies of every similarity, a crowd that shares a long line, and a chain."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    rows, line = [], [word() for _ in range(40)]
    for i in range(60):
        w = [word() for _ in range(rng.randint(3, 200))] + (line if i % 3 == 0 else [])
        rows.append((len(rows), " ".join(w)))
        for k in range(3):
            v = list(w)
            for _ in range(rng.randint(0, max(1, len(v) // 30))):
                v[rng.randrange(len(v))] = word()
            rows.append((len(rows), " ".join(v)))
    w = [word() for _ in range(100)]
    for k in range(12):
        rows.append((len(rows), " ".join(w)))
        w = w[6:] + [word() for _ in range(6)]
    return rows + [(900, None), (901, " \n"), (902, "a b"), (903, "A  b"), (904, "a b c")]


def test_same_groups_as_all_pairs(spark):
    rows = corpus()
    want = brute(rows)
    out = simhash_copies.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == want
    assert 40 < len(set(want.values())) < len(rows) - 60


def test_the_stage_drops_copies_at_0_8_and_keeps_the_rest(spark):
    rng = random.Random(8)
    w = [f"w{rng.randrange(9999)}" for _ in range(104)]
    near, far = list(w), list(w)
    near[30] = near[70] = "x"  # 90 of 110 shingles
    far[20] = far[50] = far[80] = "x"  # 85 of 115
    d = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in cp.near_dedup(spark, d, "").collect()) == [1, 3]


def test_crowded_keys_are_split_without_losing_links(spark, monkeypatch):
    rows = corpus()[:120]
    want = brute(rows)
    monkeypatch.setattr(simhash_copies, "BLOCK", 40)
    monkeypatch.setattr(simhash_copies, "SET_BLOCK", 3)
    monkeypatch.setattr(simhash_copies, "STEP", 4)
    monkeypatch.setattr(simhash_copies, "ROOM", 8)
    out = simhash_copies.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == want


def test_shared_counts(monkeypatch):
    rng = random.Random(5)
    sets = [np.unique(np.array([rng.randrange(60) for _ in range(rng.randint(1, 50))], np.uint64)) for _ in range(9)]
    monkeypatch.setattr(simhash_copies, "COLUMNS", 7)
    got = simhash_copies.shared(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(set(a.tolist()) & set(b.tolist()))
