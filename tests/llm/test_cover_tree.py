"""Cover trees and near-duplicate vectors against all pairs."""

import numpy as np
import pytest
from brute import groups
from pyspark.sql import functions as F

from gramline.llm import cover_tree

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _cloud(rng, n, dim=8, spread=0.06):
    centers = rng.normal(size=(max(1, n // 12), dim))
    return (centers[rng.integers(0, len(centers), n)] + rng.normal(size=(n, dim)) * spread).astype(np.float32)


def _expected(rows, least=0.98):
    clean = [
        (k, i, np.array(v, float), lab) for k, (i, v, lab) in enumerate(rows)
        if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for key in {(lab, len(v)) for _, _, v, lab in clean}:
        own = [(k, v) for k, _, v, lab in clean if (lab, len(v)) == key]
        x = np.array([v for _, v in own])
        norm = np.linalg.norm(x, axis=1)
        i, j = np.nonzero(np.triu(x @ x.T / np.outer(norm, norm) >= least, 1))
        links += [(own[a][0], own[b][0]) for a, b in zip(i, j, strict=True)]
    found = groups(range(len(rows)), links)
    ids = [r[0] for r in rows]
    least_id: dict = {}
    for k, root in found.items():
        if ids[k] is not None:
            least_id[root] = min(least_id.get(root, ids[k]), ids[k])
    counts = np.bincount(np.array(links, int).ravel(), minlength=len(rows)) if links else np.zeros(len(rows), int)
    return sorted(((ids[k], int(counts[k]), least_id.get(found[k]), ids[k] == least_id.get(found[k])) for k in found), key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("n, leaf, dim", [(1, 4, 3), (300, 4, 3), (700, 24, 16)])
def test_tree_holds_every_point_within_its_radii(n, leaf, dim):
    points = cover_tree._unit(_cloud(np.random.default_rng(n), n, dim).astype(float))
    tree = cover_tree.CoverTree(points, leaf)
    assert sorted(tree.order) == list(range(n))
    for node in range(len(tree.center)):
        far = cover_tree._distances(points[tree.rows(node)], points[[tree.center[node]]])
        assert far.max() <= tree.radius[node] + 1e-7
        assert tree.center[node] in tree.rows(node)
        for kid in tree.kids[node]:
            assert tree.radius[kid] < tree.radius[node] and set(tree.rows(kid)) <= set(tree.rows(node))
        if tree.kids[node]:  # halved radii: the largest power of two below the node's own bounds its kids
            half = 2.0 ** (np.ceil(np.log2(tree.radius[node])) - 1)
            assert all(tree.radius[k] <= half + 1e-7 for k in tree.kids[node])


@pytest.mark.parametrize("spread, dim", [(0.02, 3), (0.1, 6), (0.5, 16)])
def test_traversal_finds_all_pairs(spread, dim):
    rng = np.random.default_rng(5)
    raw = _cloud(rng, 500, dim, spread).astype(float)
    weight = rng.integers(1, 4, len(raw))
    near = (raw @ raw.T) / np.outer(np.linalg.norm(raw, axis=1), np.linalg.norm(raw, axis=1)) >= 0.98
    np.fill_diagonal(near, False)
    links, tree = cover_tree.Links(weight), cover_tree.CoverTree(cover_tree._unit(raw))
    cover_tree.traverse(tree, tree, raw, raw, 0.98, links)
    assert (links.linked == near @ weight).all()
    i, j = np.nonzero(near)
    assert (links.roots() == cover_tree.roots_of(len(raw), i, j)).all()
    both = cover_tree.Links(weight)
    a, b = (cover_tree.CoverTree(cover_tree._unit(x)) for x in (raw[:200], raw[200:]))
    cover_tree.traverse(a, b, raw[:200], raw[200:], 0.98, both, shift=200)
    assert (both.linked[:200] == near[:200, 200:] @ weight[200:]).all()
    assert (both.linked[200:] == near[200:, :200] @ weight[:200]).all()


def test_edges_are_kept_bounded(monkeypatch):
    monkeypatch.setattr(cover_tree, "MOST_EDGES", 50)
    links = cover_tree.Links(np.ones(300, np.int64))
    for i in range(299):
        links.pairs(np.array([i]), np.array([i + 1]))
    assert (links.roots() == 0).all() and links._n <= 351


ODD = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1),
    (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 1), (12, [1.0, 0.0, 0.0], 1),
    (None, [1.0, 0.01], 1), (None, [0.0, -5.0], 1), (13, [-1.0, 0.0], 1), (13, [-1.0, 0.001], 1), (14, [1e-30, 0.0], 1), (15, [-0.0, 3.0], 3),
    (16, [0.0, 3.0], 3),
]


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    df = df.withColumns({c: F.lit("own") for c in ("ref", "own", "vec", "vector", "n", "root", "cell", "n_links", "kept")})
    assert _got(cover_tree.near_duplicates(df)) == _expected(ODD)


@pytest.mark.parametrize("cell", [40, 100, 8192])
def test_cells_and_visits(spark, cell):
    rng = np.random.default_rng(3)
    cloud = np.concatenate([_cloud(rng, 500), np.repeat(_cloud(rng, 1), 200, axis=0), _cloud(rng, 1) + rng.normal(size=(200, 8)).astype(np.float32) * 1e-3])
    rows = [(int(i), [float(x) for x in v], int(i) % 7 == 0) for i, v in enumerate(cloud)]
    rows = [(i, v, 1 if own else 2) for i, v, own in rows] + ODD
    got = _got(cover_tree.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), cell=cell))
    assert got == _expected(rows)


def test_no_vectors(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(1, None, None)], SCHEMA)
    assert [tuple(r) for r in cover_tree.near_duplicates(alone).collect()] == [(1, 0, 1, True)]
