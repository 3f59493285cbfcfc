import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from benthos.llm import simhash


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, fps, tau=3):
    comp = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= tau:
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    return [min(ids[k] for k in range(len(ids)) if comp[k] == c) for c in comp]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=list("abC é\n\tÉ\x0b\x1c."), max_size=400))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_fingerprint_edges():
    assert simhash.fingerprint(None) == simhash.fingerprint("") == simhash.fingerprint(" \n") == 0
    long = "word other " * 40_000
    assert simhash.fingerprint(long) == brute_print(long)


def test_allocation_is_the_cheapest():
    rng = random.Random(3)
    for m in (2, 3, 4):
        costs = [{-1: 0.0} | {t: rng.random() * 10**t for t in range(4)} for _ in range(m)]
        best = min((sum(c[t] for c, t in zip(costs, ts)), ts) for ts in __import__("itertools").product(range(-1, 4), repeat=m) if sum(ts) == 3 - m + 1)
        cost, ts = simhash.allocate(costs, 3 - m + 1)
        assert abs(cost - best[0]) < 1e-9 and sum(ts) == 3 - m + 1


def links_frame(spark, fps):
    return spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), i) for i, f in enumerate(fps)], "fp long, rep long")


def test_links_match_brute_force_for_every_layout(spark, monkeypatch):
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(12):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    want = brute_components(list(range(len(fps))), fps)
    from benthos.llm.components import components

    monkeypatch.setattr(simhash, "BLOCK", 8)  # crowded keys are split
    real = simhash.plan
    for choices in ((2,), (3,), (4,), (2, 3, 4)):
        monkeypatch.setattr(simhash, "plan", lambda reps, tau, c=choices: real(reps, tau, c))
        got = {r["node"]: r["component"] for r in components(simhash.links(links_frame(spark, fps))).collect()}
        assert [got.get(i, i) for i in range(len(fps))] == want


def test_rows_nulls_repeats_and_clashing_names(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text, "x"), (3, text, None), (3, text, None), (9, None, "x"), (8, "", "x"), (None, text, "x"), (1, "something else entirely is written here today", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").withColumnRenamed("component_id", "fp")
    out = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    by = {}
    for d, _, c in out:
        by.setdefault(d, []).append(c)
    assert by == {5: [3], 3: [3, 3], 9: [8], 8: [8], None: [3], 1: [1]}


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
