import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from benthos.llm import packing
from benthos.llm.packing import Limits
from benthos.llm.tokens import WordIds

REF = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(text):
    return REF.encode(text or "", add_special_tokens=False).ids


def test_words_are_cut_as_the_tokenizer_cuts_them(monkeypatch):
    from benthos.llm import tokens

    monkeypatch.setattr(tokens, "CACHE", 50)  # the cache turns over many times
    rng = random.Random(1)
    alpha = ["a", "B", "é", "É", "Σ", "ς", "İ", "Ž", "ŉ", "ª", "ǅ", "ä", "'", "'s", "'ll", ".", "%", "###", "12", "３", "́", " ", "　", "\x0b", "\x01", "\x1c", "<|endoftext|>", "<|", "|>", "日本", "ﬁ", "😀", " ", "\n", "\t", "-", "_", "ß", "가"]
    words = WordIds()
    for _ in range(3000):
        text = "".join(rng.choice(alpha) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids(text), repr(text)


def check(rows, texts, limits):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        want, at = [*ids(text), 1], 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want)
            assert np.frombuffer(r["ids"], "<u4").tolist() == want[at : at + r["length"]]
            at += r["length"]
        assert at == len(want)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= limits.tokens and len(seq) <= limits.segments
    return by_seq


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 64), Limits(32, 8, 20)])
def test_every_id_lies_in_one_piece(spark, limits):
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice(["alpha", "Beta,", "gamma.", "12", "zzzqqx"]) for _ in range(int(rng.expovariate(1 / 40)))) for i in range(300)}
    texts |= {300: None, 301: "", 302: "very long " * 9000}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, ids int").repartition(2)
    rows = packing.pack_documents(docs, limits).collect()
    seqs = check(rows, texts, limits)
    if limits == Limits():
        used = sum(r["length"] for r in rows)
        assert used / (limits.tokens * len(seqs)) > 0.9


def test_conversations_stay_whole_within_all_limits(spark):
    rng = random.Random(4)
    rows = [(f"c{i}", rng.randint(1, 300), 0) for i in range(500)]
    rows = [(k, n, rng.randint(0, n)) for k, n, _ in rows] + [("huge", 5000, 10), ("none", None, None)]
    out = packing.pack_examples(spark.createDataFrame(rows, "k string, n long, l long").coalesce(1), Limits(1024, 6, 500), "k", "n", "l").collect()
    assert sorted(r["key"] for r in out) == sorted(r[0] for r in rows)
    seqs = {}
    for r in out:
        seqs.setdefault(r["sequence_id"], []).append(r)
    for seq in seqs.values():
        if [r["key"] for r in seq] == ["huge"]:
            continue
        assert sum(r["tokens"] for r in seq) <= 1024 and len(seq) <= 6 and sum(r["loss"] for r in seq) <= 500
    total = sum(n or 0 for _, n, _ in rows)
    assert len(seqs) < 1.3 * max(total / 1024, len(rows) / 6, sum(x or 0 for *_, x in rows) / 500)


def test_loss_is_counted_on_assistant_turns(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a b c", 1), (1, 1, "assistant", "Straße, unzerlegbar", 2), (1, 1, "assistant", "Straße, unzerlegbar", 2), (2, 0, "user", None, 3), (2, 1, "assistant", "", 4), (None, 0, None, "x y", 5)], "conv_id long, turn long, role string, text string, tokens int")
    n = len(ids("Straße, unzerlegbar"))
    want = {(1, len(ids("a b c")) + 2 * n, 2 * n), (2, 0, 0), (None, len(ids("x y")), 0)}
    assert {tuple(r) for r in packing.conversation_sizes(turns).collect()} == want
    assert packing.conversation_sizes(turns.limit(0)).count() == 0


def test_query_binds_all_three_limits(spark):
    from benthos.llm import queries

    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    size, loss = {}, {}
    for r in turns:
        n = len(ids(r["text"]))
        size[r["conv_id"]] = size.get(r["conv_id"], 0) + n
        loss[r["conv_id"]] = loss.get(r["conv_id"], 0) + n * (r["role"] == "assistant")
    seqs = {}
    rows = queries.conversation_packing(spark, "/root/testdata/sf0.01").collect()
    assert {r["conv_id"]: (r["tokens"], r["loss"]) for r in rows} == {k: (size[k], loss[k]) for k in size} and len(rows) == len(size)
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append(r)
    full = [0, 0, 0]
    for seq in seqs.values():
        used = (sum(r["tokens"] for r in seq), len(seq), sum(r["loss"] for r in seq))
        assert all(u <= c for u, c in zip(used, queries.CONVERSATIONS))
        for i, (u, c) in enumerate(zip(used, queries.CONVERSATIONS)):
            full[i] += u > 0.97 * c
    assert min(full) > 0  # each limit closes some sequence


def test_empty_and_repeated(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = packing.pack_documents(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r["doc_id"] is None, r["length"]) for r in twice) == [(False, 3), (False, 3), (True, 2)]
