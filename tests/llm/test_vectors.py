import numpy as np

from chatlake.llm import vectors as V


def brute(x, k, low):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return {(i, j) for i in range(len(x)) for j in top[i] if s[i, j] >= low}


def clusters(seed, n=1200, dims=32):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n // 6, dims))
    return (centres[r.integers(0, len(centres), n)] + 0.25 * r.normal(size=(n, dims))).astype(np.float32)


def test_graph_recall():
    x = clusters(1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = V.Graph(x)
    assert (g.edges < len(x)).all() and ((g.edges >= 0).sum(1) <= V.DEGREE).all()
    ids, sims = g.search(x, V.BEAM)
    want = brute(x, 5, -1)
    got = {(i, j) for i in range(len(x)) for j in ids[i, :6] if j != i and j >= 0}
    assert len(want & got) / len(want) > 0.95
    assert (np.diff(sims, axis=1) <= 0).all()
    for tiny in (0, 1, 2, 3):
        assert V.Graph(x[:tiny]).edges.shape[0] == tiny


def test_pairs(spark, monkeypatch):
    monkeypatch.setattr(V, "SHARD_ROWS", 150)
    x = clusters(2)
    x[300:340] = x[300]  # a group of copies
    rows = [(f"{i:05}", [float(v) for v in x[i]], "m") for i in range(len(x))]
    rows += [("00001", rows[1][1], "m"), ("00002", None, "m"), ("z0", [0.0] * 32, "m"), ("z1", [1.0] * 16, "m"), ("z2", None, "m"), ("z3", [float("nan")] * 32, "m"), (None, rows[5][1], "m")]
    df = spark.createDataFrame(rows, "source_uuid string, embedding array<float>, key string")
    got = {(int(r["id_a"]), int(r["id_b"])) for r in V.similar_pairs(df, "source_uuid", "embedding", dims=32, probes=4).collect()}
    want = {(min(p), max(p)) for p in brute(x, 5, 0.8)}
    odd = set(range(300, 340))
    assert len({p for p in want - got if not set(p) <= odd}) <= 0.1 * len(want)
    for i in range(300, 340):  # copies: the five smallest others
        assert all((min(i, j), max(i, j)) in got for j in [j for j in range(300, 306) if j != i][:5])
    assert not any(str(p).startswith("z") for p in got)
    monkeypatch.setattr(V, "SHARD_MAX", 60)
    split = {(int(r["id_a"]), int(r["id_b"])) for r in V.similar_pairs(df, "source_uuid", "embedding", dims=32, probes=4).collect()}
    assert len(got & split) > 0.9 * len(got)
    assert V.similar_pairs(df.limit(0), "source_uuid", "embedding", dims=32).count() == 0


def test_pairs_over_many_shards(spark, monkeypatch):
    """Visits as in production, with shards so small that clusters are cut by many borders."""
    monkeypatch.setattr(V, "SHARD_ROWS", 40)
    r = np.random.default_rng(7)
    x = (r.normal(size=(12, 32))[r.integers(0, 12, 1200)] + 0.35 * r.normal(size=(1200, 32))).astype(np.float32)
    df = spark.createDataFrame([(f"{i:05}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, v array<float>")
    got = {(int(r["id_a"]), int(r["id_b"])) for r in V.similar_pairs(df, "id", "v", dims=32).collect()}
    want = {(min(p), max(p)) for p in brute(x, 5, 0.8)}
    assert len(want & got) >= 0.985 * len(want)


def test_crowded_and_large_shards(spark, monkeypatch):
    """Few centroids for many vectors, so shards are routed again; few queries a task, so members stand in many rooms."""
    monkeypatch.setattr(V, "SAMPLE", 32)
    monkeypatch.setattr(V, "SAMPLE_MAX", 32)
    monkeypatch.setattr(V, "SHARD_ROWS", 60)
    monkeypatch.setattr(V, "VISITS_MAX", 200)
    monkeypatch.setattr(V, "SHARD_MAX", 450)
    x = clusters(5)
    df = spark.createDataFrame([(f"{i:05}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, v array<float>")
    rows = [(int(r["id_a"]), int(r["id_b"])) for r in V.similar_pairs(df, "id", "v", dims=32).collect()]
    want = {(min(p), max(p)) for p in brute(x, 5, 0.8)}
    assert len(rows) == len(set(rows)) and len(want & set(rows)) >= 0.9 * len(want) and len(set(rows) - want) <= 0.03 * len(want)


def test_newest_row_stands(spark):
    rows = [("a", [1.0, 0.0], "2024-01-02"), ("a", [0.0, 1.0], "2024-01-01"), ("a", None, "2024-01-03"), ("b", [1.0, 0.01], None), ("c", [0.01, 1.0], None)]
    df = spark.createDataFrame(rows, "id string, v array<float>, at string")
    got = lambda **k: {(r["id_a"], r["id_b"]) for r in V.similar_pairs(df, "id", "v", dims=2, **k).collect()}
    assert got(newest="at") == {("a", "b")}


def test_visits_grow_with_shards():
    r = np.random.default_rng(8)
    x = r.normal(size=(500, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for shards, most in ((1, 1), (3, 3), (20, 10), (400, 18)):
        c = V.fit_centroids(r.normal(size=(8 * shards, 32)).astype(np.float32), shards)
        to, go = V.visits(x, c, None, 0.8)
        assert go[:, 0].all() and to.shape[1] == most and go.sum(1).max() == most
        assert (to[:, 0] == (x @ c.T).argmax(1)).all() and all(len(set(row)) == most for row in to.tolist())
