"""Whitening, the forest and the clusters against plain NumPy, with awkward vectors."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm import projection_forest, vectors, whitening, zone_clusters

KIND = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("point", T.StringType()),
        T.StructField("cluster", T.StringType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b") for i, v in rows], KIND)


def some_vectors(n, width=64, seed=5):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((6, width))
    made = centre[rng.integers(0, 6, n)] + 0.5 * rng.standard_normal((n, width))
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(made)]


def awkward_vectors(n=300, width=64):
    """Good rows with copies, repeated and null ids, and the rows that take no part."""
    good = some_vectors(n, width)
    good += [(2000 + i, good[7][1]) for i in range(60)] + [(3, good[3][1]), (100, good[100][1])]
    good += [(None, good[9][1])]
    bad = [(5001, None), (5002, []), (5003, [0.5] * (width - 1)), (5100, [None] + [0.1] * (width - 1))]
    bad += [(5004, [float("nan")] * width), (5005, [float("inf")] + [0.0] * (width - 1))]
    rows = good + bad
    random.Random(3).shuffle(rows)
    return rows, good


def test_pivoted_cholesky_and_jacobi_give_the_eigenvectors():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((40, 9)) * np.logspace(0, -6, 9)
    for scatter in (a.T @ a, np.diag([4.0, 0.0, 1.0]), np.ones((5, 5)), np.zeros((3, 3)), a[:4].T @ a[:4]):
        order, factor = whitening.pivoted_cholesky(scatter)
        assert np.allclose(factor @ factor.T, scatter[np.ix_(order, order)], atol=1e-12)
        turned = whitening.one_sided_jacobi(factor)
        products = turned.T @ turned
        assert np.allclose(products, np.diag(products.diagonal()), atol=1e-13 * max(1, products.max(initial=0)))
        found = np.sort(products.diagonal())[::-1]
        true = np.sort(np.linalg.eigvalsh(scatter))[::-1]
        assert np.allclose(found, true[: len(found)], rtol=1e-9, atol=1e-15)
        assert np.all(true[len(found) :] <= 1e-12 * true.max(initial=0) + 1e-300)


def test_whitening_equals_numpy(spark):
    rows, good = awkward_vectors()
    out = whitening.whitened(table(spark, rows).repartition(5)).collect()
    x = np.floor(1024 * np.array([v for _, v in good], dtype=np.float64)).astype(np.int64) + 100_000
    y = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(y.T @ y / len(x))
    values, turn = values[::-1], turn[:, ::-1]
    made = y @ turn[:, :8] / np.sqrt(values[:8])
    assert len(out) == 8 * len(good)
    signs = {}
    places = {}
    for place, (i, _) in enumerate(good):
        places.setdefault(i, place)  # rows of one id have one vector here
    centred = len(x) * x - x.sum(axis=0)
    for r in out:
        place, c = places[r.vec_id], r.component - 1
        true = made[place, c]
        sign = signs.setdefault(c, np.sign(true * r.whitened))
        assert abs(sign * r.whitened - true) < 1e-9
        assert r.n == len(good) and int(r.deviation) == int((centred[place] ** 2).sum())
        assert abs(r.explained - values[c] / values.sum()) < 1e-12 and r.identity_error < 1e-9


def test_whitening_of_little_or_large(spark):
    empty = whitening.whitened(table(spark, []))
    assert empty.columns[:3] == ["vec_id", "component", "n"] and empty.count() == 0
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(4)]
    out = whitening.whitened(table(spark, line)).collect()
    assert [r.component for r in out] == [1] * 4 and abs(out[0].explained - 1) < 1e-12
    assert sorted(round(abs(r.whitened), 6) for r in out) == [0.447214, 0.447214, 1.341641, 1.341641]
    # Entries whose sums and squares do not fit a long.
    far = [(i, [v, 1.0]) for i, v in enumerate([2.0**47, -(2.0**47), 2.0**46, 1.0])]
    out = {r.vec_id: int(r.deviation) for r in whitening.whitened(table(spark, far + [(9, [2.0**52, 1.0])])).collect()}
    x = [int(1024 * v[0]) + 100_000 for _, v in far]
    assert out == {i: (4 * v - sum(x)) ** 2 for i, v in enumerate(x)}


def test_hilbert_order_visits_neighbours():
    for bits, width in ((3, 2), (2, 3), (1, 4), (2, 8)):
        grid = np.indices((1 << bits,) * width).reshape(width, -1).T if bits * width <= 9 else None
        if grid is None:
            grid = np.array(np.unravel_index(np.arange(1 << (bits * width)), (1 << bits,) * width)).T
        keys = [k.tobytes() for k in zone_clusters.hilbert_keys(grid, bits)]
        assert len(set(keys)) == len(grid)
        ordered = grid[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def plain_clusters(good, k=8, rounds=10):
    x = np.floor(1024 * np.array([v for _, v in good], dtype=np.float64)).astype(np.int64)
    hashes = [hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "z" for i, _ in good]
    first = sorted(range(len(x)), key=lambda i: (hashes[i], x[i].tolist()))[:k]
    centroids = x[first]
    for turn in range(rounds + 1):
        away = ((x[:, None] - centroids) ** 2).sum(axis=2)
        nearest = away.argmin(axis=1)
        if turn == rounds:
            return nearest, away.min(axis=1), centroids
        centroids = np.array(
            [x[nearest == c].sum(axis=0) // max(1, (nearest == c).sum()) if (nearest == c).any() else m
             for c, m in enumerate(centroids)]
        )


@pytest.mark.parametrize("block", [4, 128])
def test_clusters_equal_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(zone_clusters, "BLOCK", block)
    rows, good = awkward_vectors()
    out = zone_clusters.clustered(table(spark, rows)).collect()
    nearest, away, centroids = plain_clusters(good)
    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    wanted = sorted(
        (repr(i), int(c), int(d), int(away[nearest == c].sum()), int(away.sum()), shas[c])
        for (i, _), c, d in zip(good, nearest, away)
    )
    got = sorted(
        (repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out
    )
    assert got == wanted


def test_clusters_of_few_and_of_far_vectors(spark):
    assert zone_clusters.clustered(table(spark, [])).count() == 0
    three = some_vectors(3)
    out = zone_clusters.clustered(table(spark, three)).collect()
    assert sorted(r.cluster for r in out) == [0, 1, 2] and {r.inertia for r in out} == {0}
    # Products beyond doubles' whole numbers, and one vector that is out of range.
    far = [(i, (np.array(v) * 20_000).astype(np.float32).tolist()) for i, v in some_vectors(60)]
    out = zone_clusters.clustered(table(spark, far + [(99, [2.0**17] * 64)])).collect()
    nearest, away, _ = plain_clusters(far)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in out) == [
        (i, int(c), int(d)) for i, (c, d) in enumerate(zip(nearest, away))
    ]


def test_boxes_leave_every_nearest_centroid():
    rng = np.random.default_rng(8)
    centroids = rng.integers(-300, 300, (8, 64))
    pruned = 0
    for spread in (0, 5, 80, 400):
        x = rng.integers(-200, 200, 64) + rng.integers(-spread, spread + 1, (128, 64))
        may = zone_clusters.possible(x.min(axis=0)[None], x.max(axis=0)[None], centroids)[0]
        away = zone_clusters.distances(x, centroids)
        assert (away == ((x[:, None] - centroids) ** 2).sum(axis=2)).all()
        assert may[np.unique(away.argmin(axis=1))].all()
        pruned += 8 - may.sum()
    assert pruned > 0
    tied = zone_clusters.possible(np.zeros((1, 64)), np.zeros((1, 64)), np.stack([np.ones(64), -np.ones(64)]))
    assert tied.all()


def plain_nearest(good, queries, k=10):
    """For each query row its true neighbours among all other rows."""
    x = np.array([v for _, v in good], dtype=np.float64)
    ids = [i for i, _ in good]
    out = []
    for q in queries:
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = sorted((d, i is None, i or 0, j) for j, (d, i) in enumerate(zip(away, ids)) if j != q)
        out.append((ids[q], [(d, ids[j]) for d, _, _, j in order[:k]]))
    return out


def test_forest_finds_the_true_neighbours(spark, monkeypatch):
    monkeypatch.setattr(projection_forest, "LEAF", 16)
    monkeypatch.setattr(projection_forest, "POINTS", 10)
    monkeypatch.setattr(projection_forest, "QUERIES", 3)
    rows, good = awkward_vectors(1500)
    good = [g for g in good if any(g[1])]
    given = table(spark, rows + [(6000, [0.0] * 64)]).repartition(4)
    out = projection_forest.nearest(given, given.where("vec_id % 20 = 0")).collect()
    queries = [j for j, (i, _) in enumerate(good) if i is not None and i % 20 == 0]
    true = plain_nearest(good, queries)
    found = {}
    for r in out:
        found.setdefault((r.query_id, r.rank), []).append((r.score, r.vec_id))
    assert {len([k for k in found if k[0] == i]) for i, _ in true} == {10}
    assert len(out) == 10 * len(queries)  # id 100 stands twice, and asks twice
    hit = sum(
        wanted[1] in {v for k in range(1, 11) for _, v in found[i, k]} for i, near in true for wanted in near
    )
    assert hit >= 0.9 * 10 * len(queries)
    by_id = {}
    for i, v in good:
        by_id.setdefault(i, np.array(v, dtype=np.float64))
    for (i, _), got in found.items():
        for score, v in got:
            assert abs(score - np.sqrt(((by_id[i] - by_id[v]) ** 2).sum())) < 1e-12
    # Copies: the least ids at distance 0, but for the query's own row.
    assert [found[2000, k][0] for k in range(1, 4)] == [(0.0, 7), (0.0, 2001), (0.0, 2002)]
    assert {(0.0, 100)} <= set(found[100, 1])


def test_forest_over_few_rows_is_exact(spark):
    nothing = table(spark, [])
    assert projection_forest.nearest(nothing, nothing).count() == 0
    few = some_vectors(6, width=3)
    given = table(spark, few)
    out = projection_forest.nearest(given, given.where("vec_id = 2")).orderBy("rank").collect()
    (_, near), = plain_nearest(few, [2])
    assert [(r.rank, r.vec_id) for r in out] == [(k + 1, i) for k, (_, i) in enumerate(near)]
    alone = table(spark, few[:1])
    assert projection_forest.nearest(alone, alone).count() == 0
    # On a grid very many distances are equal: the lower ids win.
    grid = [(i, [float(i % 5), float(i // 5 % 5), 1.0]) for i in range(100)]
    given = table(spark, grid)
    out = projection_forest.nearest(given, given.where("vec_id = 12")).orderBy("rank").collect()
    (_, near), = plain_nearest(grid, [12])
    assert [r.vec_id for r in out] == [i for _, i in near]


def test_shared_queue_takes_the_nearest_borders_first():
    rng = np.random.default_rng(4)
    forest = projection_forest.planted(rng.standard_normal((512, 8)), 16_384)
    margins = forest.margins(rng.standard_normal((1, 8)))[0]
    everything = forest.leaves * len(forest.borders)
    order = forest.visited(margins, everything)
    assert sorted(order) == list(range(everything))
    missed = []
    for cell in order:
        tree, node = divmod(cell, forest.leaves)
        node += forest.inner
        total = 0.0
        while node:
            up = (node - 1) // 2
            margin = margins[tree, up]
            total += margin**2 if (node == 2 * up + 2) != (margin >= 0) else 0.0
            node = up
        missed.append(total)
    assert missed == sorted(missed)
    assert 0 < forest.visits <= everything


def test_usual_width_and_usable_rows(spark):
    given = table(spark, [(1, [1.0]), (2, [1.0, 2.0]), (3, None), (4, [])])
    assert vectors.usual_width(given, F.col("embedding")) == 2
    assert vectors.usual_width(given.limit(0), F.col("embedding")) == 0
