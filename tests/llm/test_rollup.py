import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from benthos.llm import queries, rollup


def totals(ledger):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in ledger.totals().collect()}


def test_signed_batches_commit_once(spark, tmp_path):
    led = rollup.Ledger(spark, f"file://{tmp_path}/ledger")
    assert totals(led) == {}
    rng = random.Random(3)
    docs = {i: [rng.choice("ab"), rng.choice(["en", None]), "v1", rng.randint(0, 50)] for i in range(60)}
    frame = lambda rows: spark.createDataFrame(rows, "source string, lang string, tokenizer string, n long, old long, tokens string")
    first = frame([(*v, 0, "x") for v in docs.values()])
    assert led.commit("b-1", rollup.changes(first, "insert", n="n"))
    assert not led.commit("b-1", rollup.changes(first, "insert", n="n"))  # a replay adds nothing
    changed = {i: rng.randint(0, 99) for i in range(0, 60, 3)}
    led.commit("b-2", rollup.changes(frame([(*docs[i][:3], n, docs[i][3], "x") for i, n in changed.items()]), "revise", n="n", old="old"))
    for i, n in changed.items():
        docs[i][3] = n
    led.commit("b-3", rollup.changes(frame([(*docs[i][:3], 0, docs[i][3], "x") for i in range(0, 60, 4)]), "delete", old="old"))
    for i in range(0, 60, 4):
        del docs[i]
    want = {}
    for s, g, v, n in docs.values():
        d, t = want.get((s, g, v), (0, 0))
        want[s, g, v] = (d + 1, t + n)
    assert totals(led) == want
    assert led.batches() == ["b-1", "b-2", "b-3"]
    with pytest.raises(ValueError):
        led.commit("../x", rollup.changes(first, "insert", n="n"))


def row(spark, n=5):
    return rollup.changes(spark.createDataFrame([("s", "en", "v", n)], "source string, lang string, tokenizer string, n long"), "insert", n="n")


def test_what_a_dead_writer_leaves_is_not_read(spark, tmp_path):
    led = rollup.Ledger(spark, f"file://{tmp_path}/ledger")
    rollup.signed(row(spark)).write.parquet(f"file://{tmp_path}/ledger/.try-dead")
    assert totals(led) == {} and led.batches() == []
    assert led.commit("b", row(spark))
    assert totals(led) == {("s", "en", "v"): (1, 5)}


def test_of_two_writers_one_commits(spark, tmp_path, monkeypatch):
    one, two = (rollup.Ledger(spark, f"file://{tmp_path}/ledger") for _ in range(2))
    assert one.commit("a", row(spark, 1))
    monkeypatch.setattr(two, "committed", lambda _: False)  # it looked before the other one moved in
    assert one.commit("b", row(spark, 5)) and not two.commit("b", row(spark, 7))
    assert totals(two) == {("s", "en", "v"): (2, 6)}
    monkeypatch.setattr(two, "_snapshot", lambda: 0)
    assert one.compact()
    monkeypatch.setattr(two, "batches", lambda: ["a"])
    monkeypatch.setattr(two, "_rows", lambda *_: rollup.signed(row(spark, 1)))
    assert not two.compact()  # the other's snapshot stands
    assert totals(one) == {("s", "en", "v"): (2, 6)}
    assert not [p.name for p in (tmp_path / "ledger").iterdir() if p.name.startswith(".try")]


def test_snapshots_against_brute_force(spark, tmp_path):
    """Inserts, revisions, deletes and replays in any order with snapshots anywhere."""
    rng = random.Random(8)
    led, docs, done, frame = rollup.Ledger(spark, f"file://{tmp_path}/ledger"), {}, [], lambda rows: spark.createDataFrame(rows, "source string, lang string, tokenizer string, n long, old long")
    for step in range(14):
        kind = rng.choice(["insert", "insert", "revise", "delete", "replay", "compact"]) if step > 1 else "insert"
        if kind == "compact":
            led.compact()
        elif kind == "replay":
            old = rng.choice(done)
            assert not led.commit(old, row(spark, 99))
        else:
            if kind == "insert":
                some = list(range(len(docs) + step * 100, len(docs) + step * 100 + 5))
                rows = [(rng.choice("ab"), rng.choice(["en", None]), "v", rng.randint(0, 50), None) for _ in some]
                docs |= {i: list(r) for i, r in zip(some, rows)}
            else:
                some = rng.sample(sorted(docs), min(3, len(docs)))
                rows = [(*docs[i][:3], rng.randint(0, 50), docs[i][3]) for i in some]
                for i, r in zip(some, rows):
                    if kind == "delete":
                        del docs[i]
                    else:
                        docs[i][3] = r[3]
            assert led.commit(f"s{step}", rollup.changes(frame(rows), kind, n=None if kind == "delete" else "n", old=None if kind == "insert" else "old"))
            done.append(f"s{step}")
        want = {}
        for s, g, v, n, _ in docs.values():
            d, t = want.get((s, g, v), (0, 0))
            want[s, g, v] = (d + 1, t + n)
        assert totals(led) == want


def test_query_against_brute_force(spark, tmp_path):
    docs = [(i, t, g, s, 0) for i, (t, g, s) in enumerate([("Hello world, hello!", "en", "a"), ("", "en", "a"), (None, "de", "a"), ("Straße über 12", "de", "b"), ("x" * 3000, None, None), ("two  spaces\n", "en", "a"), ("short and long words " * 9, "en", "a")])]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    toks = {"word_bpe_49k": Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), "byte_bpe_50k": Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))}
    want = {}
    for _, t, g, s, _ in docs:
        for v, tok in toks.items():
            size = len(tok.encode(t or "", add_special_tokens=False).ids)
            d, n = want.get((s, g, v), (0, 0))
            if size >= 16:
                want[s, g, v] = (d + 1, n + size)
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in queries.op3_rollup(spark, str(tmp_path)).collect()}
    assert got == want
