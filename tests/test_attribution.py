"""Shapley values of trees against all subsets."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelspark.operators import attribution as A
from panelspark.operators import boosting as B
from panelspark.operators import explain as X


def expected(tree, bins, known, node=0):
    c = tree.column[node]
    if c < 0:
        return tree.value[node]
    left, right = 2 * node + 1, 2 * node + 2
    if c in known:
        goes = tree.missing_left[node] if bins[c] == 0 else bins[c] <= tree.split[node]
        return expected(tree, bins, known, left if goes else right)
    return (tree.cover[left] * expected(tree, bins, known, left) + tree.cover[right] * expected(tree, bins, known, right)) / tree.cover[node]


def plain(trees, bins, k):
    """Every subset of the columns."""
    width = len(bins)
    worth = {s: sum(expected(trees[r, k], bins, set(s)) for r in range(len(trees.column))) for n in range(width + 1) for s in combinations(range(width), n)}
    out = np.zeros(width)
    for i in range(width):
        for s in worth:
            if i not in s:
                w = factorial(len(s)) * factorial(width - len(s) - 1) / factorial(width)
                out[i] += w * (worth[tuple(sorted((*s, i)))] - worth[s])
    return out


@pytest.fixture(scope="module")
def grown():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).round(1)
    x[rng.random(x.shape) < 0.1] = np.nan
    z = np.nan_to_num(x)
    label = ((z[:, 0] * z[:, 1] > 0).astype(int) + (z[:, 2] + z[:, 3] > 1)).astype(int)
    edges = [np.unique(c[~np.isnan(c)]) for c in x.T]
    bins = B.binned(x, edges)
    return x, label, bins, B.grow_in_task(bins, label.astype(np.uint8), np.arange(400, dtype=np.uint64), 3, B.Growth(4, 4, 0.5, rows=0.9))


def test_attributions_equal_all_subsets(grown):
    _, _, bins, trees = grown
    tables, base = A.leaf_tables(trees, 3)
    found = A.attribute(bins, tables)
    for row in range(4):
        for k in range(3):
            assert np.allclose(found[row, k], plain(trees, bins[row], k), atol=1e-12)
    margin = np.zeros((len(bins), 3))
    B.add_margins(margin, bins, trees)
    assert np.allclose(found.sum(2) + base, margin, atol=1e-10)


def test_columns_that_recur_on_a_path():
    """One column split twice is one player."""
    tree = B.Trees.empty((1, 1), 2)
    one = tree[0, 0]
    one.column[[0, 1]], one.split[[0, 1]] = 0, [9, 4]
    one.cover[:5], one.value[[2, 3, 4]] = [10, 6, 4, 5, 1], [1.0, -2.0, 3.0]
    tables, base = A.leaf_tables(tree, 1)
    bins = np.array([[3, 0], [7, 0], [20, 0]], np.uint8)
    assert base[0] == pytest.approx(0.4 - 1.0 + 0.3)
    assert np.allclose(A.attribute(bins, tables)[:, 0], [[-2 - base[0], 0], [3 - base[0], 0], [1 - base[0], 0]])


def test_query_frames(spark, grown):
    x, label, _, _ = grown
    rows = [(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "ID long, v array<double>, label int").withColumn("features", array_to_vector("v"))
    model = B.BoostedTrees(B.Growth(5, 3, 0.3)).fit(df)
    names = [f"c{i}" for i in range(8)]
    found = A.tree_attributions(model, df, names)
    got = {(r["ID"], r["class"]): r["base"] + sum(r["attributions"]) for r in found.collect()}
    margins = model.margins(x)
    assert len(got) == 1200 and all(got[i, k] == pytest.approx(margins[i, k]) for i, k in got)
    long = A.by_feature(found, df, names)
    ranking = [r["feature"] for r in X.attribution_ranking(long).collect()]
    assert set(ranking[:4]) == {"c0", "c1", "c2", "c3"}
    pairs = X.attribution_dependence(long, "c0", "c1").where(F.col("class") == 0)
    assert pairs.count() == 400 and pairs.columns == ["ID", "class", "value", "attribution", "colour"]
    assert A.tree_attributions(model, df.limit(0), names).count() == 0
