import numpy as np
import pytest

from concordat.llm import cells, topk


def best(ids, vectors, asked, k=5):
    x = np.floor(256 * vectors.astype(float))
    out = []
    for i in asked:
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out += [(int(ids[i]), r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("n, groups, copies", [(300, 0, 0), (300, 5, 0), (200, 3, 150), (3, 0, 0)])
def test_top_k_against_brute_force(spark, n, groups, copies):
    rng = np.random.default_rng(n + groups + copies)
    x = rng.normal(size=(n, 16))
    if groups:
        x = rng.normal(size=(groups, 16))[rng.integers(0, groups, n)] + 0.1 * x
    if copies:
        x[:copies] = x[0]
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 7 = 0"), shard_rows=64, block_rows=8).collect())
    assert got == best(np.arange(n), x, range(0, n, 7))


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (None, [9.0, 9.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 1.0, 1.0]), (7, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 5), (0, 2, 50), (0, 3, 7), (50, 1, 0), (50, 2, 5), (50, 3, 7)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_zero_vectors(spark):
    df = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(8)] + [(50, [1.0, -1.0, 0.0]), (51, [0.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, r, r, 0) for r in range(1, 6)] + [(50, 1, 51, 0)]
    index = topk.ImpactIndex(np.arange(8), np.zeros((8, 2)))
    assert index.search(np.array([[256.0, 0.0]]), np.array([0]), 5) == [(0, i, 0) for i in range(1, 6)]


def exact(x, t=0.9):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= t
    np.fill_diagonal(hit, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([label[i], *label[hit[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    return hit, label


def planted(n, dims, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 5, dims))
    x = base[rng.integers(0, len(base), n)] + 0.25 * rng.normal(size=(n, dims))
    x[: n // 10] = x[0]  # equal vectors
    return x


def test_cells_recall_and_precision(spark):
    x = planted(1500, 24, 5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hit, label = exact(x)
    got = {r["vec_id"]: r for r in cells.embedding_dedup(df, cell_rows=50, block_rows=64).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= hit.sum(1)).all(), "a pair below the threshold was linked, or counted twice"
    recall = links.sum() / hit.sum()
    assert recall >= 0.9, recall
    comps = np.array([got[i]["component_id"] for i in range(len(x))])
    assert (comps >= label).all() and (comps == label).mean() > 0.9
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


@pytest.mark.parametrize("dims", [16, 64])
def test_cells_recall_just_over_the_threshold_at_most_cells(dims):
    """Pairs of cosine 0.901 in random directions, at the full 2048 cells: one is sent to the other's home."""
    rng = np.random.default_rng(11)
    centres = cells.spherical_kmeans(cells.unit(rng.normal(size=(20_000, dims))), 2048, rounds=4)
    x, o = cells.unit(rng.normal(size=(4000, dims))), rng.normal(size=(4000, dims))
    o = cells.unit(o - (o * x).sum(1, keepdims=True) * x)
    y = 0.901 * x + np.sqrt(1 - 0.901**2) * o

    def met(probes):
        a, b = cells.nearest(x, centres, probes), cells.nearest(y, centres, probes)
        return ((a == b[:, :1]) | (b == a[:, :1])).any(1).mean()

    print(dims, "recall with 4:", met(4), "now:", met(None))
    assert len(centres) == 2048 and met(4) < 0.9 and met(None) >= 0.98


def test_cells_single_cell_is_exact(spark):
    x = planted(400, 8, 6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hit, label = exact(x)
    got = {r["vec_id"]: r for r in cells.embedding_dedup(df, max_cells=1, block_rows=32).collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == hit.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == label.tolist()


def test_cells_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (8, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in cells.embedding_dedup(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (2, 2, 1, False), (8, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (None, 0, None, True)], key=str)
    assert cells.embedding_dedup(df.limit(0)).count() == 0


def test_top_k_stops_on_proof():
    """On clustered vectors queries stop early, on random ones later; the results are exact either way."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(100, 64))
    clustered = centres[rng.integers(0, 100, 2000)] + 0.3 * rng.normal(size=(2000, 64))
    for x, most in ((clustered, 0.5), (rng.normal(size=(2000, 64)), 0.95)):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        v = np.floor(256 * x)
        index = topk.ImpactIndex(np.arange(2000), v)
        got = sorted((i, j, s) for i, j, s in index.search(v[:40], np.arange(40), 5))
        assert got == sorted((i, j, s) for i, _, j, s in best(np.arange(2000), x, range(40)))
        assert index.processed <= most * index.whole


def test_top_k_blocks_and_clashing_names(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 6))
    df = spark.createDataFrame([(i, v.tolist(), "a", "b", "c", "d") for i, v in enumerate(x)], "vec_id long, embedding array<double>, id string, v string, shard string, rank string")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 3 = 0"), shard_rows=32, block_rows=7).collect())
    assert got == best(np.arange(120), x, range(0, 120, 3))


def test_cells_clashing_names_and_repeated_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", "y", "z", "u") for r in rows], "vec_id long, embedding array<double>, id string, v string, rep string, cell string")
    got = sorted(tuple(r) for r in cells.embedding_dedup(df).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


@pytest.mark.parametrize("n, cell_rows, max_cells", [(1500, 150, 2048), (3000, 30, 2048), (3000, 30, 8)])
def test_cells_recall_on_distinct_pairs(spark, n, cell_rows, max_cells):
    """10 and 100 cells, and 100 in two levels: pairs of different vectors just over the threshold, none of them equal."""
    rng = np.random.default_rng(n)
    x = cells.unit(rng.normal(size=(n // 2, 24)))
    o = rng.normal(size=x.shape)
    o = cells.unit(o - (o * x).sum(1, keepdims=True) * x)
    c = rng.uniform(0.905, 0.99, (len(x), 1))
    x = np.concatenate([x, c * x + np.sqrt(1 - c * c) * o])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hit, _ = exact(x)
    got = {r["vec_id"]: r["n_links"] for r in cells.embedding_dedup(df, cell_rows=cell_rows, max_cells=max_cells, block_rows=64).collect()}
    links = np.array([got[i] for i in range(len(x))])
    assert (links <= hit.sum(1)).all() and hit.sum() >= n
    assert links.sum() >= 0.95 * hit.sum(), links.sum() / hit.sum()
