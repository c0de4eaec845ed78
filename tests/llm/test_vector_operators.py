"""Vector operators against brute force."""

import numpy as np
import pytest

from pricegrain.llm import covertree, projections
from pricegrain.llm.common import local_components

KINDS = "vec_id long, embedding array<float>, label int, score string"


def vectors():
    r = np.random.default_rng(11)
    rows = [r.normal(size=16) for _ in range(150)]
    rows += [rows[3] + r.normal(size=16) * s for s in (0.05, 0.1, 0.2) for _ in range(40)]  # a tight group
    rows += [rows[5]] * 30 + [rows[6] * 3.0]  # copies, and a copy in direction
    out = [(int(i), [float(np.float32(x)) for x in v], 0, "") for i, v in enumerate(rows)]
    nan, inf = float("nan"), float("inf")
    return out + [(1000, None, 0, ""), (1050, [], 0, ""), (1001, [0.0] * 16, 0, ""), (1002, [nan] + [1.0] * 15, 0, ""), (1003, [inf] + [1.0] * 15, 0, ""), (1004, [None] + [1.0] * 15, None, ""), (1100, [1.0, 2.0], 0, ""), (1101, [2.0, 4.0], 0, "")]


def good(rows):
    return [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]


def cosines(some):
    ids, x = np.array([i for i, _ in some]), [v for _, v in some]
    out = np.full((len(x), len(x)), -2.0)
    for i, a in enumerate(x):
        for j, b in enumerate(x):
            if len(a) == len(b):
                out[i, j] = (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())
    return ids, out


@pytest.mark.parametrize("block", [2048, 24])
def test_covertree(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    rows = vectors()
    ids, cos = cosines(good(rows))
    near = cos >= 0.9
    label = local_components(len(ids), *np.nonzero(near))
    want = {int(i): (int(near[k].sum()) - 1, int(ids[label[k]])) for k, i in enumerate(ids)}
    out = covertree.near_duplicates(spark.createDataFrame(rows, KINDS).repartition(4)).collect()
    assert len(out) == len(rows)
    for r in out:
        n, component = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"], r["kept"]) == (n, component, component == r["vec_id"])


def test_covertree_without_vectors(spark):
    empty = spark.createDataFrame([], KINDS)
    assert covertree.near_duplicates(empty).count() == 0
    bad = spark.createDataFrame([(1, None, 0, ""), (2, [0.0], 0, "")], KINDS)
    assert sorted(map(tuple, covertree.near_duplicates(bad).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_dual_traversal_counts_all_pairs():
    r = np.random.default_rng(12)
    for _ in range(12):
        d, k = int(r.integers(2, 9)), int(r.integers(1, 7))
        cloud = lambda n: covertree.unit(r.normal(size=(k, d))[r.integers(0, k, n)] + r.normal(size=(n, d)) * r.choice([0.01, 0.2, 1.0], size=(n, 1)))  # noqa: B023, E731
        x, y = cloud(int(r.integers(1, 90))), cloud(int(r.integers(1, 90)))
        wx, wy = r.integers(1, 5, len(x)), r.integers(1, 5, len(y))
        a, b = covertree.Tree(x), covertree.Tree(y)
        near = x @ y.T >= 0.9
        ca, cb, p, q = covertree.tally(covertree.dual(x, a, y, b, 0.9), a, wx, b, wy)
        assert (ca == near @ wy).all() and (cb == wx @ near).all()
        n, (i, j) = len(x) + len(y), np.nonzero(near)
        assert (local_components(n, i, j + len(x)) == local_components(n, p, q + len(x))).all()


def test_a_tight_group_costs_node_pairs_not_its_square():
    r = np.random.default_rng(13)
    x = covertree.unit(np.ones(32) + r.normal(size=(3000, 32)) * 0.01)
    t = covertree.Tree(x)
    assert sum(len(p) for _, p, _, _ in covertree.dual(x, t, x, t, 0.9)) < 10


def test_projections(spark, monkeypatch):
    monkeypatch.setattr(projections, "SHARD", 64)
    monkeypatch.setattr(projections, "QUERIES", 3)
    rows = vectors()
    out = projections.search(spark.createDataFrame(rows, KINDS), every=10).collect()
    ids, cos = cosines(good(rows))
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for k, i in enumerate(ids):
        if i % 10:
            assert int(i) not in got
            continue
        own = [(-cos[k, j], int(ids[j])) for j in range(len(ids)) if j != k and cos[k, j] > -2]
        best = sorted(own)[:5]
        found = sorted(got[int(i)])
        assert [x[0] for x in found] == list(range(1, len(best) + 1))
        score = {v: -s for s, v in own}
        assert all(s == pytest.approx(score[v], abs=1e-12) for _, v, s in found)
        assert [(-round(s, 10), v) for _, v, s in found] == sorted((-round(s, 10), v) for _, v, s in found)
        hits += len({v for _, v in best} & {v for _, v, _ in found})
        total += len(best)
    assert hits / total >= 0.9 and len(got[1100]) == 1
    assert projections.search(spark.createDataFrame([], KINDS)).count() == 0


def test_quantile():
    assert projections.quantile(16, 0.95) == pytest.approx(26.296, abs=0.01)


def test_any_number_of_vector_lengths(spark):
    rows = [(100 * n + i, [1.0] * n + [float(i)]) for n in range(1, 80) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r["vec_id"]: r for r in covertree.near_duplicates(df).collect()}
    assert len(out) == len(rows)
    for n in (1, 40, 79):
        own = [np.array(v) for _, v in rows if len(v) == n + 1]
        cos = [[float(a @ b / np.sqrt((a @ a) * (b @ b))) for b in own] for a in own]
        assert [out[100 * n + i]["n_links"] for i in range(3)] == [sum(cos[i][j] >= 0.9 for j in range(3) if j != i) for i in range(3)]
    found = projections.search(df, every=50).collect()
    assert {r["query_id"]: 0 for r in found} == {i: 0 for i, _ in rows if i % 50 == 0} and all(r["query_id"] // 100 == r["vec_id"] // 100 for r in found)


def test_neighbours_stop_before_all_are_verified():
    """Clustered vectors: a query meets its own cluster and stops; recall and the verified share are those of the README's rule."""
    r = np.random.default_rng(3)
    centre = r.standard_normal((40, 64))
    x = centre[r.integers(0, 40, 4000)] + 0.15 * r.standard_normal((4000, 64))
    ids, some = np.arange(4000), np.arange(0, 4000, 100)
    found = list(projections.nearest(ids, x, ids[some], x[some], 5, 16, 0.95, 42))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in some:
        cos = u @ u[q]
        cos[q] = -2
        hits += len({*np.argsort(-cos)[:5].tolist()} & {f[1] for f in found if f[0] == q})
    assert hits / (5 * len(some)) >= 0.9 and np.mean([f[3] for f in found]) < 0.2 * 4000
