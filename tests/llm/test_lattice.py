import numpy as np

from benthos.llm import lattice


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    p = lattice.decode(x)
    twice = (2 * p).astype(int)
    assert (np.all(twice % 2 == 0, 1) | np.all(twice % 2 == 1, 1)).all() and (p.sum(1) % 2 == 0).all()
    d = ((x - p) ** 2).sum(1)
    assert (d <= ((x[:, None] - p[:, None] - lattice.ROOTS[None]) ** 2).sum(2).min(1) + 1e-9).all()
    assert len(lattice.ROOTS) == 240 and d.max() <= 1 + 1e-9


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string")


def brute(vecs):
    ids = [i for i, _ in vecs]
    ok = [v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v) and any(v) for _, v in vecs]
    n, comp = len(vecs), list(range(len(vecs)))
    links = [0] * n
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(vecs[i][1]) == len(vecs[j][1]):
                a, b = np.array(vecs[i][1], np.float32).astype(float), np.array(vecs[j][1], np.float32).astype(float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    x, y = comp[i], comp[j]
                    comp = [y if c == x else c for c in comp]
    least = {}
    for i, c in zip(ids, comp):
        least[c] = min(least.get(c, i), i)
    return sorted((i, links[k], least[comp[k]], i == least[comp[k]]) for k, i in enumerate(ids))


def test_counts_components_and_edges(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vecs, k = [], 100
    for size in (1, 2, 5, 40):
        for _ in range(4):
            c = rng.normal(size=64)
            for _ in range(size):
                vecs.append((k, (c + rng.normal(size=64) * 0.12).tolist()))
                k += 1
    vecs += [(900 + i, vecs[0][1]) for i in range(30)]  # copies of one vector
    vecs += [(1, None), (2, []), (3, [0.0] * 64), (4, [float("nan")] * 64), (5, [float("inf")] + [1.0] * 63), (6, [None] + [1.0] * 63), (7, [1.0] * 8), (8, [2.0] * 8), (9, [1.0] * 3)]
    want = brute(vecs)
    for block in (512, 7):  # 7: crowded cells are split
        monkeypatch.setattr(lattice, "BLOCK", block)
        got = sorted(tuple(r) for r in lattice.near_duplicates(frame(spark, [(i, v, "c") for i, v in vecs])).collect())
        assert got == want


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    u = rng.normal(size=(400, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.952 * u + np.sqrt(1 - 0.952**2) * w
    rows = [(i, x.tolist(), "c") for i, x in enumerate(np.concatenate((u, v)))]
    out = lattice.near_duplicates(frame(spark, rows)).where("n_links > 0").count()
    assert out / 800 >= 0.98


def test_empty_null_ids_and_doubles(spark):
    assert lattice.near_duplicates(frame(spark, [])).count() == 0
    d = spark.createDataFrame([(None, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in lattice.near_duplicates(d).collect()), key=str) == sorted([(4, 2, 4, True), (4, 2, 4, True), (None, 2, None, None)], key=str)


def test_shared_and_null_ids_are_vectors_of_their_own(spark):
    rng = np.random.default_rng(4)
    c = rng.normal(size=64)
    near = [(c + rng.normal(size=64) * 0.1).tolist() for _ in range(4)]
    for ids in ((1, 1, 2), (None, 1, 2), (None, None, 3), (7, 7, 7)):
        rows = list(zip(ids, near, strict=False)) + [(9, [1.0] + [0.0] * 63)]
        got = [tuple(r) for r in lattice.near_duplicates(frame(spark, [(i, v, "c") for i, v in rows])).collect()]
        least = min(i for i in ids if i is not None)
        want = [(i, 2, least if i is not None else None, i == least if i is not None else None) for i in ids] + [(9, 0, 9, True)]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_the_twin_says_the_same(spark):
    import duckdb

    from benthos.llm import queries

    con = duckdb.connect()
    con.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op9_lattice"]).fetchall())
    got = sorted(tuple(r) for r in queries.op9_lattice(spark, "/root/testdata/sf0.001").select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == want
