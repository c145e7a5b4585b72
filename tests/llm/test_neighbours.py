import numpy as np
import pytest
from pyspark.sql import functions as F

from voltaflow.llm import neighbours, queries

MID = "/root/testdata/sf0.1"


def brute(rows, asks, k):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if asks(q):
            all_ = sorted((-float((x * v).sum()), i) for i, v in rows if i != q)
            out[q] = [(i, -s) for s, i in all_[:k]]
    return out


def as_dict(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MID}/embeddings.parquet").collect()]
    got = as_dict(queries.op2_neighbours(spark, MID).collect())
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert got.keys() == want.keys()
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.95
    vec = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 20
        for i, s in found:
            assert s == pytest.approx(float(vec[q] @ vec[i]), abs=1e-12)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_lists_prune_on_clustered_data():
    rng = np.random.default_rng(1)
    middle = rng.standard_normal((40, 16)) * 5
    x = middle[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 16))
    c = neighbours.centroids(x, 40)
    graph = neighbours.Graph.build(c, degree=8)
    ids, d = graph.search(x[:500], 32)
    true = np.linalg.norm(x[:500, None] - c[None], axis=2)
    assert (np.sort(true, axis=1)[:, 0] >= d[:, 0] - 1e-2).mean() > 0.98
    assert (d <= neighbours.PROBE * d[:, :1]).sum(axis=1).mean() < 0.3 * len(c)
    near = np.argmin(((x[:, None] - c[None]) ** 2).sum(axis=2), axis=1)
    assert np.bincount(near).max() < 5 * len(x) / len(c)


def test_whole_search_with_blocks_norms_copies_and_ties(frame, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(6) * rng.random() * 4).astype(np.float32).tolist()) for k in range(300)]
    rows += [(k, rows[5][1]) for k in range(400, 460)]  # a hot vector, with queries among its copies
    docs = frame([(*r, "s") for r in rows], "vec_id long, embedding array<float>, score string")
    got = as_dict(neighbours.nearest(docs, F.col("vec_id") % 20 == 0, list_rows=40, probe=1e9).collect())
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])


def test_no_cap_on_the_lists_of_a_query():
    rng = np.random.default_rng(6)
    c, x = rng.standard_normal((700, 12)), rng.standard_normal((30, 11))
    band = neighbours.Band(1.0, 0, neighbours.Graph.build(c))
    d = np.linalg.norm(neighbours._queries(x)[:, None] - c[None], axis=2)
    seen = total = 0
    for factor in (1.05, 1.8, 1e9):
        want = [set(np.flatnonzero(r <= factor * r.min() * (1 - 1e-4))) for r in d]
        got = neighbours.visited([band], x, factor, np.ones(700, int), 1)
        seen += sum(len(w & set(g.tolist())) for w, g in zip(want, got))
        total += sum(map(len, want))
    assert max(map(len, want)) == 700 and seen >= 0.995 * total


def test_lists_are_widened_until_they_hold_enough():
    rng = np.random.default_rng(7)
    c, x = rng.standard_normal((50, 5)), rng.standard_normal((9, 4))
    band = neighbours.Band(1.0, 3, neighbours.Graph.build(c))
    rows = np.array([0, 0, 0] + [1] * 50)
    for least in (1, 21, 50, 1000):
        for own in neighbours.visited([band], x, 1.0001, rows, least):
            assert rows[own].sum() >= min(least, 50) and len(set(own.tolist())) == len(own)


@pytest.mark.parametrize("scale", [30.0, 1e5, 1e20, 1e200])
def test_one_very_long_vector(frame, scale):
    rng = np.random.default_rng(11)
    middle = rng.standard_normal((30, 16))
    x = middle[rng.integers(0, 30, 3000)] + 0.3 * rng.standard_normal((3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[77] *= scale
    rows = list(enumerate(x.tolist()))
    got = as_dict(neighbours.nearest(frame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, list_rows=100).collect())
    s = x[::20] @ x.T
    s[np.arange(len(s)), np.arange(0, 3000, 20)] = -np.inf
    want = {20 * k: set(np.argsort(-r, kind="stable")[:20].tolist()) for k, r in enumerate(s)}
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & want[q]) / 20 for q in want]) >= 0.95


def test_large_finite_components(frame):
    rows = [(k, [1e19 * (k + 1), -1e18]) for k in range(30)] + [(100, [1e300, 1e300]), (120, [3e38, 0.0])]
    got = as_dict(neighbours.nearest(frame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect())
    assert got.keys() == {0, 20, 100, 120} and all(len(v) == 20 for v in got.values())
    assert got[0][0][0] == 120  # with 100 the product has no value, which counts as minus infinity
    assert 100 not in dict(got[0])
    assert got[100][0] == (120, float("inf"))


def test_recall_with_several_hundred_lists_of_unstructured_vectors(frame):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = list(enumerate(x.tolist()))
    docs = frame(rows, "vec_id long, embedding array<float>")
    got = as_dict(neighbours.nearest(docs, F.col("vec_id") % 20 == 0, list_rows=12).collect())
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.97


def test_odd_vectors(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (8, [1.0]), (None, [1.0, 2.0]), (20, [-1.0, 0.5]), (40, None)]
    got = as_dict(neighbours.nearest(frame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect())
    assert got == {0: [(1, 1.0), (20, -1.0)], 20: [(1, -0.5), (0, -1.0)]}
    one = neighbours.nearest(frame(rows[:1], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0)
    assert one.collect() == []


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty(frame, rows):
    assert neighbours.nearest(frame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0
