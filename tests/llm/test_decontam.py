import random
import re
import time

import pytest

from benthos.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    win = {}
    for i, t in items:
        w = words(t)
        for g in [tuple(w)] if 0 < len(w) < 10 else [tuple(w[k : k + 10]) for k in range(len(w) - 9)]:
            win.setdefault(g, set()).add(None if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in win}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in win:
                    hit |= set(range(k, k + n))
                    found |= win[g]
        out.append((d, len(w), len(hit), len(found), sorted(found, key=lambda x: (x is None, x or "")), len(hit) > 0))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "text as w", "doc_id as h", "1 as items")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as n")
    return sorted((tuple(r) for r in decontam.contamination(d, i).collect()), key=str)


@pytest.mark.parametrize("most", [decontam.BROADCAST_ROWS, 0])
def test_random_texts_with_planted_passages(spark, monkeypatch, most):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", most)
    rng = random.Random(7)
    vocab = ["a", "b", "C", "é", "dog", "9", "Ünter", "x1"]  # few words, so windows repeat and overlap
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.randint(0, 40))) for i in range(12)] + [(20, "B a"), (21, "dog, dog dog"), (22, None), (23, ""), (24, "one two three four five six seven eight nine ten"), (None, "null item"), (25, "lone")]
    items.append((None, items[3][1]))  # a null id beside a known one
    docs = [(i, text(rng.randint(0, 200))) for i in range(25)]
    docs += [(30 + k, text(30) + (t or "").upper().replace("É", "é") + " " + text(30)) for k, (_, t) in enumerate(items)]
    docs += [(60, None), (61, ""), (62, "...")]
    docs.append((62, docs[0][1]))  # one id, two texts
    docs.append(docs[0])  # a repeated row
    docs.append((None, items[0][1]))
    assert run(spark, docs, items) == brute(docs, items)


def test_a_long_span_is_always_found(spark):
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(300)]
    docs = [(i, " ".join([*(f"q{rng.random()}" for _ in range(5)), *passage[i : i + 10], "end"])) for i in range(0, 290, 7)]
    out = run(spark, docs, [(1, " ".join(passage))])
    assert all(r[2] == 10 and r[4] == ["1"] for r in out)


def test_very_long_document_and_both_join_ways(spark, monkeypatch):
    passage = " ".join(f"w{k}" for k in range(60))
    docs = [(1, "noise " * 60_000 + passage + " tail" * 20_000), (2, "noise " * 50)]
    want = brute(docs, [(5, passage)])
    assert run(spark, docs, [(5, passage)]) == want
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)  # the shuffled form
    assert run(spark, docs, [(5, passage)]) == want


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c")]) == []
    assert run(spark, [(1, "a b c")], []) == [(1, 3, 0, 0, [], False)]


def test_the_plan_stays_in_the_jvm(spark, capsys):
    d = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    out = decontam.contamination(d, spark.createDataFrame([(1, "a " * 12)], "item_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_shuffled_form_on_long_texts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(40)]
    docs = [(i, " ".join([*(f"q{rng.randrange(50_000)}" for _ in range(60_000)), *passage])) for i in range(4)]
    began = time.perf_counter()
    assert [r[2] for r in run(spark, docs, [(1, " ".join(passage))])] == [40] * 4
    assert time.perf_counter() - began < 40  # words sent with each fingerprint took this long for a third of the words


def test_the_twin_says_the_same(spark):
    import duckdb

    from benthos.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op10_decontam"]).fetchall(), key=str)
    got = queries.op10_decontam(spark, "/root/testdata/sf0.001").select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=str) == want and any(r[2] for r in want)
