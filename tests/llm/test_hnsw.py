import numpy as np
import pytest

from tessera.llm import hnsw as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep string, k1 string, n string, comp string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], lab, "a", "b", "c", "d") for i, v, lab in rows], SCHEMA)


def clustered(seed=3, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dim))
    noise = rng.choice([0.0, 0.03, 0.08, 0.4], n)[:, None]
    return (centres[rng.integers(0, len(centres), n)] + noise * rng.normal(size=(n, dim))).astype(np.float32)


def brute(rows, threshold=0.98):
    ok = {k: np.array(v, np.float64) for k, (_, v, lab) in enumerate(rows) if v is not None and lab is not None and len(v)
          and None not in list(v) and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    links = {k: set() for k in range(len(rows))}
    for a, x in ok.items():
        for b, y in ok.items():
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].add(b)
    comp = {k: rows[k][0] for k in links}
    changed = True
    while changed:
        changed = False
        for a, near in links.items():
            for b in near:
                if comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return sorted((rows[k][0], len(links[k]), comp[k], rows[k][0] == comp[k]) for k in links)


@pytest.mark.parametrize("shard", [8192, 60])
def test_links_and_components_equal_brute_force(spark, shard):
    x = clustered()
    rows = [(1000 - i, list(map(float, v)), i % 3) for i, v in enumerate(x)]
    got = sorted(tuple(r) for r in H.near_duplicate_vectors(frame(spark, rows), shard=shard).collect())
    assert got == brute(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0, 0], 0), (2, [2, 0, 0], 0), (3, [1, 0, 0], 0), (4, [1, 0, 0], 1), (5, [1, 0, 0], None), (6, None, 0), (7, [], 0),
            (8, [0, 0, 0], 0), (9, [nan, 0, 0], 0), (10, [inf, 0, 0], 0), (11, [1, None, 0], 0), (12, [1, 0], 0), (13, [-1, 0, 0], 0),
            (14, [1, -0.0, 0], 0), (15, [1e30, 1e28, 0], 0)]
    got = sorted(tuple(r) for r in H.near_duplicate_vectors(frame(spark, rows)).collect())
    assert got == brute(rows)
    assert H.near_duplicate_vectors(frame(spark, [])).count() == 0


def linked(q, x, same):
    graph = H.Graph(x)
    return H.links_of(q, x, same, graph, H.audited_beam(graph, x))


def test_dense_group_beyond_the_beam():
    rng = np.random.default_rng(5)
    x = H.unit(np.concatenate([rng.normal(size=12) + 0.01 * rng.normal(size=(300, 12)), rng.normal(size=(500, 12))]))
    truth = x @ x.T >= 0.98
    np.fill_diagonal(truth, False)
    assert truth[:300].sum() > 300 * 290
    assert np.array_equal(linked(x, x, True), truth)


def test_recall_of_the_graph_alone():
    x = H.unit(clustered(seed=9, n=3000, dim=24))
    ids, _ = H.Graph(x).query(x[:300], H.BEAM)
    exact = np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    recall = np.mean([len(set(i) & set(e)) / 10 for i, e in zip(ids, exact)])
    assert recall >= 0.9


def test_beam_widens_until_the_audit_passes(monkeypatch):
    beams, query = [], H.Graph.query

    def short_sighted(self, q, beam):
        beams.append(beam)
        ids, sims = query(self, q, beam)
        return (ids, sims) if beam >= 200 else (np.full_like(ids, -1), np.full_like(sims, -9))

    monkeypatch.setattr(H.Graph, "query", short_sighted)
    x = H.unit(clustered(seed=2, n=600))
    assert H.audited_beam(H.Graph(x), x) == 256 and beams == [64, 128, 256]


def test_planted_neighbours_lie_above_the_threshold():
    x = H.unit(clustered(seed=8, n=900, dim=20))
    at, q = H.planted(x, 0.98)
    cosine = np.einsum("nd,nd->n", x[at], q)
    assert len(set(at.tolist())) == H.AUDIT and cosine.min() >= 0.98 - 1e-9 and cosine.max() <= 1 and cosine.std() > 0.003


def test_failed_audit_is_counted_directly(monkeypatch):
    monkeypatch.setattr(H.Graph, "query", lambda self, q, beam: (np.full((len(q), beam), -1), np.full((len(q), beam), -9.0)))
    x = H.unit(np.concatenate([clustered(seed=6, n=1200, dim=12)] * 2) + 1e-4)
    truth = x @ x.T >= 0.98
    assert H.audited_beam(H.Graph(x), x) == 0
    assert np.array_equal(linked(x, x[:900], False), truth[:, :900])
    np.fill_diagonal(truth, False)
    assert np.array_equal(linked(x, x, True), truth)


@pytest.mark.parametrize("noise", [0.02, 1.0])
def test_recall_of_links_on_dense_and_sparse_shards(noise):
    """Against brute force: clusters with many links, and random vectors with a few dozen."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 48))
    x[2000:2400] = x[:400] + 0.1 * rng.normal(size=(400, 48))
    if noise < 1:
        x = x[rng.integers(0, 300, 4000)] + noise * rng.normal(size=x.shape)
    x = H.unit(x)
    truth = x @ x.T >= 0.98
    np.fill_diagonal(truth, False)
    got = linked(x, x, True)
    assert not (got & ~truth).any() and truth.any()
    assert (got & truth).sum() >= 0.995 * truth.sum()


def test_graph_survives_packing():
    x = H.unit(clustered(seed=3, n=500))
    graph = H.Graph(x)
    again = H.Graph.unpack(graph.pack(), x)
    assert all(np.array_equal(a, b) for a, b in zip(graph.query(x[:50], 64), again.query(x[:50], 64)))


def test_one_graph_per_shard_of_the_given_table(spark, tmp_path):
    """Every shard's graph is built once and written, sparse tables included."""
    import glob
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    before = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/tables/vector-graphs-*"))
    H.near_duplicate_vectors(df, shard=100)
    made = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/tables/vector-graphs-*")) - before
    graphs = spark.read.parquet(made.pop())
    assert graphs.count() == graphs.select("label", "dim", "shard").distinct().count() > df.select("label").distinct().count()
    assert graphs.where("beam = 0").count() == 0 and not made
