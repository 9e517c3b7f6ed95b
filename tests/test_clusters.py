"""Clusterings of vectors against plain versions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from panelspark.operators import balls as B
from panelspark.operators import ward as W


def plain_dbscan(ids, points, eps, least):
    near = ((points[:, None] - points[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    label = np.where(core, ids, np.iinfo(np.int64).max)
    while True:
        linked = np.where(near & core[None], label[None], np.iinfo(np.int64).max).min(1)
        new = np.where(core, np.minimum(label, linked), label)
        if (new == label).all():
            break
        label = new
    found = np.where(core, label, linked)
    return {int(i): (bool(c), None if x == np.iinfo(np.int64).max else int(x)) for i, c, x in zip(ids, core, found)}


def shapes():
    rng = np.random.default_rng(4)
    ball = rng.normal(size=(150, 5)) * 0.05
    yield "plane", rng.normal(size=(400, 2)), 0.15, 4
    yield "crowded ball and copies", np.concatenate([ball, rng.normal(size=(200, 5)), np.repeat(rng.normal(size=(1, 5)), 60, 0)]), 0.5, 5
    yield "line in 64 dimensions", np.cumsum(rng.normal(size=(300, 64)) * 0.05, 0), 0.45, 3
    yield "zeros of both signs", np.array([[0.0, -0.0], [-0.0, 0.0], [5.0, 5.0]]), 0.5, 2


@pytest.mark.parametrize("block", [2048, 16])
@pytest.mark.parametrize("name,points,eps,least", list(shapes()), ids=[x[0] for x in shapes()])
def test_density_clusters_equal_all_pairs(spark, monkeypatch, block, name, points, eps, least):
    monkeypatch.setattr(B, "BLOCK", block)
    ids = np.random.default_rng(1).permutation(len(points)) * 3
    df = spark.createDataFrame([(int(i), x.tolist(), 0) for i, x in zip(ids, points)], "id long, v array<double>, far int")
    got = {r["id"]: (r["core"], r["cluster"]) for r in B.dbscan_vectors(df, eps, least).collect()}
    assert got == plain_dbscan(ids, points, eps, least)


def test_density_clusters_of_odd_rows(spark):
    rows = [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [0.0, 0.0]), (5, [0.0, 0.1]), (5, [0.0, 0.1])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted(((r["id"] or 0, r["core"], r["cluster"]) for r in B.dbscan_vectors(df, 0.5, 3).collect()))
    assert got == [(0, True, 5), (1, False, None), (2, False, None), (3, False, None), (4, False, None), (5, True, 5), (5, True, 5)]
    assert B.dbscan_vectors(df.limit(0), 0.5, 3).count() == 0
    assert {r["core"] for r in B.dbscan_vectors(df.filter("id < 4"), 0.5, 1).collect()} == {False}
    with pytest.raises(ValueError):
        B.dbscan_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>"), 0.5, 3)


def test_a_crowded_ball_meets_nobody_of_its_own(spark, monkeypatch):
    """Points that are all neighbours of each other are core without meeting: no visit for each pair of blocks."""
    monkeypatch.setattr(B, "BLOCK", 32)
    rng = np.random.default_rng(2)
    points = np.concatenate([[[0.0, 0.0, 0.0]], rng.normal(size=(1500, 3)) * 1e-3])
    visits, real = [], B._visits
    monkeypatch.setattr(B, "_visits", lambda *a: (visits.append(real(*a)), visits[-1])[1])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id long, v array<double>")
    found = B.dbscan_vectors(df, 1.0, 5, pivots=1)
    assert {(r["core"], r["cluster"]) for r in found.collect()} == {(True, 0)}
    assert sum(v.count() for v in visits) == 0


def test_a_point_is_sent_once_to_a_hold(spark, monkeypatch):
    """Where every point reaches every cell, it travels once for each hold and not once for each cell, for the same clusters."""
    monkeypatch.setattr(B, "BLOCK", 64)
    monkeypatch.setattr(B, "STREAMS", 3)
    monkeypatch.setattr(B, "HELD_BYTES", 12_000)
    points = np.random.default_rng(7).normal(size=(300, 24))
    visits, real = [], B._visits
    monkeypatch.setattr(B, "_visits", lambda *a: (visits.append(real(*a)), visits[-1])[1])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id long, v array<double>")
    got = {r["id"]: (r["core"], r["cluster"]) for r in B.dbscan_vectors(df, 4.8, 4).collect()}
    assert got == plain_dbscan(np.arange(300), points, 4.8, 4)
    assert {core for core, _ in got.values()} == {True, False}
    assert visits[0].count() <= 5 * 300


def plain_ward(points, k):
    """The closest pair each time; groups as sorted lists."""
    groups, weight, mean = [[i] for i in range(len(points))], np.ones(len(points)), points.astype(float).copy()
    alive = np.ones(len(points), bool)
    while alive.sum() > k:
        cost = ((mean[:, None] - mean[None]) ** 2).sum(2) * weight[:, None] * weight[None] / (weight[:, None] + weight[None])
        cost[~alive], cost[:, ~alive] = np.inf, np.inf
        np.fill_diagonal(cost, np.inf)
        a, b = sorted(np.unravel_index(cost.argmin(), cost.shape))
        mean[a] = (weight[a] * mean[a] + weight[b] * mean[b]) / (weight[a] + weight[b])
        weight[a] += weight[b]
        groups[a] += groups[b]
        alive[b] = False
    return sorted(sorted(groups[i]) for i in np.flatnonzero(alive))


def squares_within(points, groups):
    return sum(((points[g] - points[g].mean(0)) ** 2).sum() for g in groups)


def vectors(spark, points):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id long, v array<double>").select("id", array_to_vector("v").alias("features"))


def clusters(model, df):
    found = {}
    for r in model.transform(df).collect():
        found.setdefault(r["prediction"], []).append(r["id"])
    return sorted(sorted(x) for x in found.values())


def test_chain_equals_closest_pairs():
    rng = np.random.default_rng(0)
    for _ in range(4):
        points = rng.normal(size=(70, 4)) + rng.integers(0, 2, (70, 1)) * 2
        features = W.Features(np.ones(70), points, np.zeros(70))
        for k in (1, 3, 7, 70, 90):
            group = W.cut(70, W.ward_tree(features), k)
            assert sorted(sorted(np.flatnonzero(group == c).tolist()) for c in range(group.max() + 1)) == plain_ward(points, max(k, 1))


def test_ward_equals_plain_version(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 6)) + rng.integers(0, 3, (500, 1)) * 1.5
    df = vectors(spark, np.concatenate([points, points[:1].repeat(40, 0)]).copy())
    model = W.WardClustering(4).fit(df)
    whole = np.concatenate([points, points[:1].repeat(40, 0)])
    assert clusters(model, df) == plain_ward(whole, 4) and model.spread == 0
    sizes = [len(x) for x in sorted(clusters(model, df), key=len, reverse=True)]
    assert sizes == [r["count"] for r in model.transform(df).groupBy("prediction").count().orderBy("prediction").collect()]


def test_summaries_lose_little(spark, monkeypatch):
    """3,000 rows in tasks of 400 over summaries of 120 features: squares within 5 percent of the plain method's."""
    monkeypatch.setattr(W, "ROWS", 400)
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3000, 3)) + rng.integers(0, 3, (3000, 1)) * 3.0
    df = vectors(spark, points)
    model = W.WardClustering(3, most=120).fit(df)
    assert len(model.features) <= 120 and model.features.weight.sum() == 3000 and model.spread > 0
    own = points[np.random.default_rng(1).permutation(3000)[:600]]
    got, want = squares_within(points, clusters(model, df)), squares_within(own, plain_ward(own, 3)) * 5
    assert got < 1.05 * want
    again = W.WardClustering(3, most=120).fit(df.repartition(7))
    assert clusters(again, df) == clusters(model, df)


def test_ward_of_many_rows_equals_plain_version(spark, monkeypatch):
    """240 rows in blocks of 90, in rounds, one task and the driver: the plain method's clusters, also where the cut undoes merges of the first rounds."""
    monkeypatch.setattr(W, "ROWS", 90)
    monkeypatch.setattr(W, "HELD", 60)
    rng = np.random.default_rng(11)
    cloud = rng.normal(size=(190, 3)) + rng.integers(0, 3, (190, 1)) * 1.2
    apart = np.array([[400.0, 0, 0], [0, 300, 0], [0, 305, 0], [0, 0, 900], [0, 0, 930]])
    powers = 2.0 ** (np.arange(25)[:, None] / 4) * np.array([[-3.0, 1, 0]])
    points = np.concatenate([cloud, apart, powers, cloud[:20]])
    df = vectors(spark, points)
    for k in (3, 80):
        model = W.WardClustering(k, most=20).fit(df)
        assert clusters(model, df) == plain_ward(points, k)
    sizes = [len(x) for x in sorted(clusters(model, df), key=len, reverse=True)]
    assert sizes == [r["count"] for r in model.transform(df).groupBy("prediction").count().orderBy("prediction").collect()]
    assert len(model.features) <= 20 and model.features.weight.sum() == 240
    new = vectors(spark, np.array([[0.0, 0.5, 890.0]]))
    assert model.transform(new).first()["prediction"] == model.label[((model.features.mean - [0.0, 0.5, 890.0]) ** 2).sum(1).argmin()]


def test_ward_of_few_rows(spark):
    df = vectors(spark, np.array([[1.0, 2.0], [1.0, 2.0]]))
    assert clusters(W.WardClustering(3).fit(df), df) == [[0, 1]]
    assert W.WardClustering(3).fit(df.limit(0)).transform(df.limit(0)).count() == 0


def test_rows_to_cluster_are_filled_once(spark):
    """The filter on filled rows reads stored columns instead of filling each row once a column."""
    from workload.learning import filled_rows

    plan = filled_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "transform(" not in plan.lower()
