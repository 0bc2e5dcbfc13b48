import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentide.llm import posting_ann
from retentide.llm.posting_ann import nearest
from retentide.llm.spark_util import checkpoint

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, neighbours=20):
    valid = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(valid)
    matrix = np.array([valid[i] for i in ids])
    out = {}
    for i in ids:
        if i % 20 == 0:
            score = np.einsum("j,ij->i", valid[i], matrix)
            order = [(-s, j) for s, j in zip(score, ids, strict=True) if j != i]
            out[i] = [(j, -s) for s, j in sorted(order)[:neighbours]]
    return out


def run(spark, rows, neighbours=20):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, neighbours).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def recall(got, expected):
    return np.mean([len({j for j, _ in got[q]} & {j for j, _ in e}) / len(e) for q, e in expected.items()])


@pytest.mark.parametrize("kind", ["uniform", "clustered", "long and short"])
def test_recall_and_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(posting_ann, "LIST_ROWS", 50)
    draw = np.random.default_rng(3)
    x = draw.standard_normal((3000, 16))
    if kind == "clustered":
        x = draw.standard_normal((30, 16))[draw.integers(0, 30, 3000)] * 3 + 0.5 * x
    if kind == "long and short":
        x *= draw.uniform(0.2, 5, (3000, 1))
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    expected, got = brute(rows), run(spark, rows)
    assert set(got) == set(expected) and all(len(v) == 20 for v in got.values())
    assert recall(got, expected) >= 0.95
    scores = {q: dict(e) for q, e in brute(rows, 3000).items()}
    assert all(abs(scores[q][j] - s) < 1e-12 for q, v in got.items() for j, s in v)


def test_lists_differ_for_clusters(monkeypatch):
    """On clustered vectors the ratio leaves most lists out."""
    draw = np.random.default_rng(5)
    x = draw.standard_normal((40, 24))[draw.integers(0, 40, 8000)] * 4 + 0.3 * draw.standard_normal((8000, 24))
    index = posting_ann.fit_index(x, len(x), float(np.linalg.norm(x, axis=1).max()), 20)
    read = posting_ann.query_lists(index, index.direction(x[:100]), np.full(40, 200), 168)
    assert len(index.centroids) == 40 and np.mean([len(r) for r in read]) < 12
    sizes = np.bincount([h[0] for h in posting_ann.home_lists(index, index.place(x))], minlength=40)
    assert sizes.max() < 6 * sizes.mean()


def test_graph_search_finds_the_nearest():
    draw = np.random.default_rng(6)
    c = draw.standard_normal((500, 8))
    near, entries = posting_ann._graph(c)
    index = posting_ann.ListIndex(c, near, entries, 1.0, np.inf, 0.0, 1, c, np.arange(500))
    points = draw.standard_normal((200, 8))
    nodes, dist = posting_ann.search_graph(index, points, 32)
    exact = np.sqrt(posting_ann._squared(points, c))
    assert (nodes[:, 0] == exact.argmin(axis=1)).mean() > 0.95
    assert np.allclose(np.take_along_axis(exact, nodes, axis=1), dist)
    assert (np.diff(dist, axis=1) >= 0).all()


def test_copies_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 200)] + [(500 + i, [0.5, 0.5]) for i in range(5)]
    rows += [(1000, None), (1020, []), (1040, [0.0, 0.0]), (1060, [None, 1.0]), (1080, [float("nan"), 1.0]), (1100, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1120, [1.0, 2.0, 3.0]), (20, [1.0, 0.0])]
    expected = brute([r for r in rows if r[0] != 1120])
    assert run(spark, rows) == expected
    assert [j for j, _ in expected[0]] == list(range(1, 21))


def test_few_and_none(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0])]) == {}
    assert run(spark, [(0, [1.0, 2.0]), (1, [3.0, 1.0])]) == {0: [(1, 5.0)]}


def test_what_is_stored_does_not_grow_with_the_lists_read(spark, monkeypatch):
    """Without structure every query reads most lists: neither its vector nor a list's goes to disk for each of them."""
    draw = np.random.default_rng(8)
    rows = [(20 * i, [float(np.float32(a)) for a in v], 0) for i, v in enumerate(draw.standard_normal((1500, 16)))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stored = {}
    for list_rows in (300, 30):
        monkeypatch.setattr(posting_ann, "LIST_ROWS", list_rows)
        kept = []
        monkeypatch.setattr(posting_ann, "checkpoint", lambda d, kept=kept: kept.append(out := checkpoint(d)) or out)
        assert nearest(df, F.col("vec_id") >= 0, 5).count() == 1500 * 5
        stored[list_rows] = sum(len(pickle.dumps([tuple(r) for r in d.collect()])) for d in kept)
    assert stored[30] < 1.5 * stored[300]
    assert stored[30] < 10 * len(rows) * 16 * 4


def test_an_id_with_several_vectors_and_doubles(spark):
    rows = [(0, [1.0, 1e-12]), (1, [0.5, 0.1]), (1, [0.25, 0.2]), (1, [0.5, 0.1]), (2, [0.3, 0.3]), (3, [0.25, 0.2]), (20, [0.1, 0.9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = [tuple(r) for r in nearest(df, F.col("vec_id") % 20 == 0, 4).orderBy("query_id", "rank").collect()]
    score = lambda a, b: a[0] * b[0] + a[1] * b[1]
    asked = {0: (1.0, 1e-12), 20: (0.1, 0.9)}
    others = sorted({(i, tuple(v)) for i, v in rows})
    expected = []
    for q, v in asked.items():
        best = sorted((-score(v, w), i) for i, w in others if i != q)[:4]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert all(abs(g[3] - e[3]) < 1e-15 for g, e in zip(got, expected, strict=True))


@pytest.mark.parametrize("share", [0.05, 0.8])
@pytest.mark.parametrize("kind", ["spread", "near ties"])
def test_blocks_of_queries_keep_the_best(monkeypatch, share, kind):
    """Whether a block is scored at once or list by list, also where vectors are in two lists or nearly alike."""
    monkeypatch.setattr(posting_ann, "CANDIDATES", 100)
    draw = np.random.default_rng(9)
    x = draw.standard_normal((2000, 8)) if kind == "spread" else 1 + 1e-9 * draw.standard_normal((2000, 8))
    queries = draw.standard_normal((60, 8))
    lists = draw.integers(0, 40, 2000)
    entries = sorted([(k, i) for i, k in enumerate(lists)] + [((k + 1) % 40, i) for i, k in enumerate(lists) if i % 3 == 0])
    read = draw.random((60, 40)) < share
    block = posting_ann.AskedBlock(queries, np.full(60, -np.inf), read, float(np.linalg.norm(x, axis=1).max()), 6)
    for lo in range(0, len(entries), 500):
        own = np.array(entries[lo : lo + 500])
        keys = np.zeros(len(own), posting_ann.KEY)
        keys["rep"] = keys["h"] = own[:, 1]
        block.meet(keys, x[own[:, 1]], *np.unique(own[:, 0], return_counts=True))
    block.cut()
    got = {}
    for q, key, value in zip(*block.found[0], strict=True):
        got.setdefault(int(q), []).append((int(key["rep"]), float(value)))
    for q in range(60):
        seen = {i for k, i in entries if read[q, k]}
        best = sorted((-np.einsum("j,j", queries[q], x[i]), i) for i in seen)[:6]
        assert np.allclose([s for _, s in got.get(q, [])], [-s for s, _ in best], rtol=0, atol=1e-14)
        assert kind == "near ties" or [i for i, _ in got.get(q, [])] == [i for _, i in best]


def test_near_lists_of_boundary_vectors():
    """The nearest list, and near ones that no chosen list is nearer to than the vector."""
    draw = np.random.default_rng(10)
    c = draw.standard_normal((60, 2))
    near, entries = posting_ann._graph(c)
    index = posting_ann.ListIndex(c, near, entries, 1.0, np.inf, 0.0, 1, c, np.arange(60))
    points = draw.standard_normal((300, 2))
    homes = posting_ann.home_lists(index, points)
    nodes, dist = posting_ann.search_graph(index, points, posting_ann.BREADTH)
    for own, row, far in zip(homes, nodes.tolist(), dist.tolist(), strict=True):
        chosen = []
        for node, d in zip(row, far, strict=True):
            if d <= posting_ann.BOUNDARY * far[0] and len(chosen) < posting_ann.REPLICAS and all(np.linalg.norm(c[k] - c[node]) > d for k in chosen):
                chosen.append(node)
        assert own == chosen
    assert max(map(len, homes)) > 1


def test_wide_beam_has_the_nearest_centroids():
    draw = np.random.default_rng(11)
    c = draw.standard_normal((900, 8))
    near, entries = posting_ann._graph(c)
    index = posting_ann.ListIndex(c, near, entries, 1.0, np.inf, 0.0, 1, c, np.arange(900))
    points = draw.standard_normal((50, 8))
    exact = np.sort(np.sqrt(posting_ann._squared(points, c)), axis=1)
    for breadth in (100, 900):
        nodes, dist = posting_ann.search_graph(index, points, breadth)
        assert np.allclose(dist, exact[:, :breadth]) and all(len(set(row)) == breadth for row in nodes.tolist())
