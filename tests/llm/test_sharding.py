import heapq
import random
import zlib

import numpy as np

from benthos.llm import sharding


def test_levelling_is_the_heap():
    rng = np.random.default_rng(1)
    for _ in range(60):
        loads, size, n = rng.integers(0, 50, 5).astype(float), float(rng.integers(1, 9)), int(rng.integers(0, 60))
        heap = [(x, i) for i, x in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(n):
            x, i = heapq.heappop(heap)
            heapq.heappush(heap, (x + size, i))
        assert sorted(x for x, _ in heap) == sorted(loads + sharding.level(loads, size, n) * size)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 50)  # many chunks
    rng = random.Random(6)
    texts = ["x" * int(rng.expovariate(1 / 300)) + str(rng.random()) for _ in range(600)]
    rows = [(i, rng.choice(texts[:3]) if i % 10 == 0 else texts[i % 600], "s") for i in range(900)] + [(901, None, "s"), (902, "", "s"), (None, "é", "s"), (0, "dup", "s"), (0, "dup", "s")]
    out = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string, shard string")).collect()
    assert len(out) == len(rows)
    groups, shards = {}, {}
    by = {}
    for r in out:
        groups.setdefault(bytes(r["text_sha256"]), set()).add(r["shard"])
        shards.setdefault(r["shard"], []).append(r)
        by.setdefault(r["doc_id"], []).append(r)
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    for i, t, _ in rows:
        b = (t or "").encode()
        assert any((r["size"], r["text_crc32"]) == (len(b) + 1, zlib.crc32(b)) for r in by[i])
    sizes = [sum(r["size"] for r in s) for s in shards.values()]
    biggest = max(sum(r["size"] for r in out if bytes(r["text_sha256"]) == g) for g in groups)
    assert len(sizes) == 16 and max(sizes) <= max(1.02 * sum(sizes) / 16, biggest * 1.02)


def test_a_hot_group_takes_a_shard_and_the_rest_level_out(spark):
    rows = [(i, "hot" * 30 if i % 2 else f"text {i} " * (i % 7)) for i in range(2000)]
    sizes = {r["shard"]: r["s"] for r in sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 4).groupBy("shard").agg({"size": "sum"}).toDF("shard", "s").collect()}
    rest = sorted(sizes.values())[:-1]
    assert max(rest) - min(rest) <= 0.02 * max(rest)


def test_empty(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_written_shards_hold_the_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i % 5}", "en") for i in range(40)], "doc_id long, text string, lang string")
    sharding.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r["doc_id"] for r in back.collect()) == list(range(40))
    assert back.select("text", "shard").distinct().count() == 5
