"""Cover trees and their dual traversal against brute force."""

import math

import numpy as np
import pytest

from windvane.llm import vectors as V


def clustered(n, dim, seed, spread=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), dim))
    return V.unit(centres[rng.integers(len(centres), size=n)] + spread * rng.normal(size=(n, dim)))


def reachable(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("dim,leaf", [(2, 4), (8, 16), (64, 1)])
def test_tree(dim, leaf):
    points = clustered(300, dim, 1)
    tree = V.cover_tree(points, leaf)
    assert sorted(tree.order) == list(range(300))
    inside = points[tree.order]
    for node in range(len(tree.start)):
        far = V._chord(inside[tree.start[node] : tree.end[node]], inside[tree.start[node]])
        assert far.max() <= tree.radius[node] + 1e-7
        kids = range(tree.child[node], tree.child[node] + tree.children[node])
        if len(kids):  # the levels are nested: the first child has the same centre, and children cover the node
            assert tree.start[kids[0]] == tree.start[node] and tree.end[kids[-1]] == tree.end[node]
            assert max(tree.radius[k] for k in kids) <= tree.radius[node] + 1e-7 and len(kids) > 1


@pytest.mark.parametrize("dim,cosine", [(2, 0.999), (8, 0.93), (64, 0.93), (8, 0.2)])
def test_dual_traversal(dim, cosine):
    a, b = clustered(250, dim, 2), clustered(180, dim, 2)
    ta, tb = V.cover_tree(a), V.cover_tree(b, 3)
    a, b = a[ta.order], b[tb.order]
    got = [(int(i), int(j)) for x, y in V.dual_links(a, ta, b, tb, cosine, False) for i, j in zip(x, y, strict=True)]
    assert len(got) == len(set(got)) and set(got) == {(int(i), int(j)) for i, j in zip(*np.nonzero(a @ b.T >= cosine), strict=True)}
    own = [(int(i), int(j)) for x, y in V.dual_links(a, ta, a, ta, cosine, True) for i, j in zip(x, y, strict=True)]
    assert len(own) == len(set(own)) and set(own) == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(a @ a.T >= cosine, 1)), strict=True)}


@pytest.mark.parametrize("block", [16, 64, 1024])
def test_against_brute_force(spark, monkeypatch, block):
    """Small blocks make several cells and blocks of one label; one label holds most rows, one vector many copies."""
    monkeypatch.setattr(V, "BLOCK", block)
    points = clustered(220, 6, 4, 0.2).astype(np.float32)
    points[150:190] = points[3]
    labels = [0 if i % 5 else 1 for i in range(220)]
    rows = [(i, p.tolist(), x) for i, (p, x) in enumerate(zip(points, labels, strict=True))]
    out = {r["vec_id"]: r for r in V.vector_near_dups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    unit = V.unit(points)
    near = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, True)
    root = reachable(near)
    assert [out[i]["n_links"] for i in range(220)] == (near.sum(axis=1) - 1).tolist()
    assert [out[i]["component_id"] for i in range(220)] == root.tolist()
    assert [out[i]["kept"] for i in range(220)] == (root == np.arange(220)).tolist()


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.01], 1), (2, [1.0, 0.0], 2), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (None, [1.0, 0.0], 1),
        (12, [1e-30, 0.0], 1), (13, [1e-30, 0.0], 1), (14, [-0.0, 3.0], 3), (15, [0.0, 3.0], 3),
    ]
    data = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<float>, label int, id string, vec string")
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in V.vector_near_dups(data).collect()}
    assert len(out) == 17
    for i in (0, 1, 11, 12, 13):
        assert out[i] == (4, 0, i == 0)
    assert out[14] == (1, 14, True) and out[15] == (1, 14, False)
    for i in (2, 3, 4, 5, 6, 7, 8, 9, 10):
        assert out[i] == (0, i, True)
    assert out[None] == (0, None, False)
    assert V.vector_near_dups(data.limit(0)).count() == 0


def test_sample_is_drawn_from_crowded_labels(spark):
    """Many small labels beside a large one send nothing to the driver."""
    points = spark.range(6000).selectExpr("id", "if(id < 500, -1, id % 500) as label", "array(1.0D, id) as vec", "2 as dim")
    crowded = points.groupBy("label", "dim").count().where("count > 100")
    assert {r["label"] for r in V._sample(points, crowded, 1.0).collect()} == {-1}
    assert V._sample(points, crowded, 1.0).count() == 500
    assert 0 < V._sample(points, crowded, 0.2).count() < 250
