"""Every stage against a brute-force version, on small tables with nulls, repeats and clashing names."""

import random

import pytest

import corpus_pipeline as cp

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture()
def tables(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(25)) for i in range(4)]
    rows, labels, toxic, leaked, copies = [], [], set(), set(), {}
    for i in range(300):
        t = text(rng.randint(20, 60))
        if i % 7 == 0:
            t += " moron scum trash"
            toxic.add(i)
        elif i % 11 == 0:
            t += " " + items[i % 4][1]
            leaked.add(i)
        elif i % 13 == 0 and i:
            copies[i] = i - 1 if (i - 1) % 7 and (i - 1) % 11 else None
            t = dict(rows)[i - 1] if copies[i] is not None else t
        elif i % 17 == 0:
            t += " write to joe.12@mail.example.com"
        rows.append((i, t))
        if i % 2 == 0:
            labels.append((i, 1, int(i in toxic)))
    rows += [(400, None), (401, ""), (402, text(20)), (402, dict(rows)[1])]
    rows[-1] = rows[-2]  # a repeated row
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), d, rows, toxic, leaked


def test_stage_by_stage(spark, tables):
    sf, d, rows, toxic, leaked = tables
    kept = cp.reject_toxic(spark, d, sf)
    assert kept.columns == COLUMNS
    left = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"]) 
    assert left == sorted((i, t) for i, t in rows if t and i not in toxic)

    from tests.llm.test_simhash import brute_components, brute_print

    kept.write.parquet(f"{sf}/s1")
    one = cp.near_dedup(spark, spark.read.parquet(f"{sf}/s1"), sf)
    now = [(r["doc_id"], r["text"]) for r in kept.collect()]
    comp = brute_components([i for i, _ in now], [brute_print(t) for _, t in now])
    want = sorted({i for (i, _), c in zip(now, comp) if i == c})
    assert one.columns == COLUMNS and sorted(r["doc_id"] for r in one.collect()) == want

    one.write.parquet(f"{sf}/s2")
    two = cp.decontaminate(spark, spark.read.parquet(f"{sf}/s2"), sf)
    assert two.columns == COLUMNS and sorted(r["doc_id"] for r in two.collect()) == [i for i in want if i not in leaked]

    two.write.parquet(f"{sf}/s3")
    three = cp.mask_pii(spark, spark.read.parquet(f"{sf}/s3"), sf)
    masked = {r["doc_id"]: r for r in three.collect()}
    assert three.columns == COLUMNS and sorted(masked) == [i for i in want if i not in leaked]
    for i, t in rows:
        if i in masked and t:
            assert masked[i]["text"] == t.replace("joe.12@mail.example.com", "[EMAIL]") and masked[i]["n_chars"] == len(masked[i]["text"])

    three.write.parquet(f"{sf}/s4")
    four = cp.pack(spark, spark.read.parquet(f"{sf}/s4"), sf).collect()
    assert {r["doc_id"] for r in four} == set(masked)


def test_run_and_empty(spark, tables, tmp_path):
    sf, d, *_ = tables
    assert cp.run(spark, sf).count() > 100
    d.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0


def test_decisions_are_of_rows_not_of_ids(spark, tmp_path):
    rng = random.Random(3)
    a, b, c, d, item = (" ".join(f"w{rng.randrange(9999)}" for _ in range(40)) for _ in range(5))
    schema = "doc_id long, text string"
    # 5 leads its own group and is a copy in another; 7 has two texts; a null id repeats a text.
    docs = spark.createDataFrame([(5, a), (6, a), (4, b), (5, b), (7, c), (7, d), (7, c), (None, a), (None, item), (None, item)], schema)
    one = cp.near_dedup(spark, docs, "")
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in one.collect()))) == sorted(map(repr, [(5, a), (4, b), (7, c), (7, d), (None, item)]))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, a), (1, f"{b} {item}"), (None, item), (None, c)], schema)
    two = cp.decontaminate(spark, docs, str(tmp_path))
    assert sorted(r["text"] for r in two.collect()) == sorted([a, c])
