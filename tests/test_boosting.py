"""Boosted trees against a plain version, split by split."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelspark.operators import boosting as B
from panelspark.operators import models as M


def plain_tree(bins, g, h, chosen, columns, growth):
    """{node: (column, split, missing left, cover) or (None, value)}, grown node by node over lists of rows."""
    found, todo = {}, [(0, np.flatnonzero(chosen), 0)]
    while todo:
        node, rows, level = todo.pop()
        total_g, total_h = g[rows].sum() / B.UNIT, h[rows].sum() / B.UNIT
        best = (growth.gamma, None)
        for c in np.flatnonzero(columns):
            b = bins[rows, c]
            for split in range(1, 255):
                for missing_left in (True, False):
                    left = np.where(b == 0, missing_left, b <= split)
                    gl, hl = g[rows][left].sum() / B.UNIT, h[rows][left].sum() / B.UNIT
                    gr, hr = total_g - gl, total_h - hl
                    if min(hl, hr) < max(growth.min_child, 1e-9):
                        continue
                    gain = (gl**2 / (hl + growth.ridge) + gr**2 / (hr + growth.ridge) - total_g**2 / (total_h + growth.ridge)) / 2
                    key = (int(c), split, missing_left)
                    order = (not missing_left, int(c), split)
                    if gain > best[0] + 1e-9 or best[1] and abs(gain - best[0]) <= 1e-9 and order < best[2]:
                        best = (gain, key, order)
        if best[1] is None or level == growth.depth:
            found[node] = (None, -total_g / (total_h + growth.ridge) * growth.rate)
            continue
        c, split, missing_left = best[1]
        found[node] = (*best[1], total_h)
        b = bins[rows, c]
        left = np.where(b == 0, missing_left, b <= split)
        todo += [(2 * node + 1, rows[left], level + 1), (2 * node + 2, rows[~left], level + 1)]
    return found


def table(n=160, width=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).round(1)
    x[rng.random(x.shape) < 0.15] = np.nan
    label = (np.nan_to_num(x[:, 0]) > 0).astype(int) + (np.nan_to_num(x[:, 1]) + rng.normal(size=n) * 0.3 > 0.7)
    return x, label


def frame(spark, x, label):
    rows = [(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "ID long, v array<double>, label int").withColumn("features", array_to_vector("v")).drop("v")


GROWTH = B.Growth(4, 3, 0.3, rows=0.8, columns=0.75)


def test_trees_equal_plain_version():
    x, label = table()
    edges = [np.unique(c[~np.isnan(c)]) for c in x.T]
    bins, keys = B.binned(x, edges), np.arange(len(x), dtype=np.uint64) * np.uint64(77)
    trees = B.grow_in_task(bins, label.astype(np.uint8), keys, 3, GROWTH)
    margin = np.zeros((len(x), 3))
    inner = 0
    for round_ in range(GROWTH.rounds):
        g, h = B.gradients(margin, label)
        chosen = B.sampled_rows(keys, GROWTH, round_)
        assert 0 < chosen.sum() < len(x)
        for k in range(3):
            columns = B.sampled_columns(4, GROWTH, round_, k)
            assert columns.sum() == 3
            tree = trees[round_, k]
            want = plain_tree(bins, g[:, k], h[:, k], chosen, columns, GROWTH)
            for node, (c, *rest) in want.items():
                if c is None:
                    assert tree.column[node] == -1 and tree.value[node] == pytest.approx(rest[0])
                else:
                    assert (tree.column[node], tree.split[node], tree.missing_left[node]) == (c, *rest[:2])
                    assert tree.cover[node] == pytest.approx(rest[2])
                    inner += 1
        B.add_margins(margin, bins, trees[round_:round_ + 1])
    assert inner > 20


def test_many_blocks_give_the_trees_of_one(spark, monkeypatch):
    x, label = table(400)
    df = frame(spark, x, label)
    one = B.BoostedTrees(GROWTH).fit(df)
    monkeypatch.setattr(B, "STORED", 3)
    for block, parts in ((50, 3), (399, 1)):
        monkeypatch.setattr(B, "BLOCK", block)
        many = B.BoostedTrees(GROWTH).fit(df.repartition(parts))
        for f in ("column", "split", "missing_left", "value", "cover", "gain"):
            assert np.array_equal(getattr(one.trees, f), getattr(many.trees, f))


def test_fewer_rows_of_two_siblings_are_summed(monkeypatch):
    rng = np.random.default_rng(7)
    bins, node = np.asfortranarray(rng.integers(0, 255, (500, 3)).astype(np.uint8)), rng.integers(-1, 8, 500)
    node[node == 5] = 4
    g, h = np.rint(rng.normal(size=500) * B.UNIT), np.rint(rng.random(500) * B.UNIT)
    above, want = B.histogram(bins, node >> 1, g, h, 4), B.histogram(bins, node, g, h, 8)
    read, real = [], B.histogram
    monkeypatch.setattr(B, "histogram", lambda bins, node, *rest: read.append((node >= 0).sum()) or real(bins, node, *rest))
    np.testing.assert_array_equal(B.histogram_below(above, bins, node, g, h), want)
    assert sum(read) <= (node >= 0).sum() / 2


def test_tables_of_a_few_hundred_thousand_rows_need_no_exchange(spark, monkeypatch):
    """Exchanges, one a level and round, cost a sweep over such tables more time than the sums do."""
    def run(self):
        raise AssertionError("an exchange")

    monkeypatch.setattr(B._Boosting, "run", run)
    df = spark.range(70_000).selectExpr("id AS ID", "array(double(id % 7), double(id % 11)) AS v", "int(id % 7 > 2) AS label")
    model = B.BoostedTrees(B.Growth(1, 2)).fit(df.withColumn("features", array_to_vector("v")))
    assert len(model.trees.column) == 1 and model.trees.cover[0, 0, 0] > 10_000


def test_gradients_are_slopes_of_the_loss():
    rng = np.random.default_rng(2)
    margin, label = rng.normal(size=(20, 3)), rng.integers(0, 3, 20)
    loss = lambda m: -np.log(B.probabilities(m)[np.arange(20), label])
    g, h = B.gradients(margin, label)
    for k in range(3):
        step = np.zeros(3)
        step[k] = 1e-5
        slope = (loss(margin + step) - loss(margin - step)) / 2e-5
        assert np.allclose(g[:, k] / B.UNIT, slope, atol=1e-6)
    p = B.probabilities(margin)
    assert np.allclose(h / B.UNIT, 2 * p * (1 - p), atol=1e-8)


def test_model_scores_and_odd_rows(spark):
    x, label = table(300)
    df = frame(spark, x, label)
    odd = spark.createDataFrame([(900, [float("nan")] * 4, None), (901, [float("inf"), float("-inf"), 0.0, 1.0], None)], "ID long, v array<double>, label int")
    df = df.unionByName(odd.withColumn("features", array_to_vector("v")).drop("v"))
    model = B.BoostedTrees(B.Growth(20, 3, 0.3)).fit(df)
    rows = model.transform(df).withColumn("p", F.col("probability")).collect()
    right = [r["prediction"] == r["label"] for r in rows if r["label"] is not None]
    assert len(rows) == 302 and sum(right) > 0.95 * len(right)
    assert all(abs(sum(r["p"].toArray()) - 1) < 1e-12 and r["prediction"] == int(np.argmax(r["p"].toArray())) for r in rows)
    assert model.featureImportances.toArray()[:2].sum() > 0.6
    assert model.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        B.BoostedTrees().fit(df.where("label IS NULL"))


def test_catalogue_entries(spark):
    x, label = table(120)
    df = frame(spark, x, label)
    for entry in (M.baseline_models()["xgboost_tuned"], M.advanced_models()["gradient_boosting"]):
        model = entry.make().fit(df)
        assert model.trees.column.shape[:2] == (entry.make().growth.rounds, 3)
        assert model.transform(df).where("prediction = label").count() > 100
