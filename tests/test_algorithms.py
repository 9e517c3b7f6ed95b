import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from panelspark.functions.quantiles import column_quantiles
from panelspark.operators.correlate import correlation_matrix
from panelspark.functions.sketch import f_tail, normal_quantile
from panelspark.operators import explain as X
from panelspark.operators.density import connected_components, dbscan
from panelspark.operators.models import FourierFeatures, assemble
from panelspark.operators.reduce import components_needed, fit_components
from panelspark.operators.sampling import sample_columns, sample_rows
from panelspark.operators.scale import fit_scaler
from tests.data import collected, panel_frame, returns, to_spark


def test_normal_quantile():
    p = np.concatenate([np.geomspace(1e-7, 0.5, 50), 1 - np.geomspace(1e-7, 0.5, 50)])
    want = [statistics.NormalDist().inv_cdf(float(v)) for v in p]
    np.testing.assert_allclose(normal_quantile(p), want, rtol=1e-7, atol=1e-8)


@pytest.mark.parametrize("f,d", [(0.3, 10.0), (2.5, 40.0), (9.0, 1000.0)])
def test_f_tail_closed_form(f, d):
    assert math.isclose(f_tail(f, 2.0, d), (1 + 2 * f / d) ** (-d / 2), rel_tol=1e-10)


def test_quantiles_by_counting_equal_single_pass(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({
        "a": rng.normal(size=3000) * 1e6,
        "b": np.where(rng.random(3000) < 0.5, 7.0, rng.normal(size=3000)),  # one value holds half of the rows
        "c": rng.integers(0, 3, 3000).astype(float),
        "d": np.nan,
    })
    df = to_spark(spark, frame)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    counted = column_quantiles(df, list("abcd"), probs)
    for c in "abc":
        np.testing.assert_allclose(counted[c], frame[c].quantile(probs))
    assert counted["d"] == [None] * len(probs)


def test_quantiles_take_nan_and_infinities(spark):
    inf = float("inf")
    rows = [(v, 1.0) for v in (1.0, 2.0, float("nan"), inf, None, -inf, 3.0)]
    cuts = column_quantiles(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0])
    assert cuts == {"a": [-inf, 1.0, 2.0, 3.0, inf], "b": [1.0] * 5}


def test_pairwise_correlations_of_many_columns(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(size=(60, 20)) + 1e4, columns=[f"r{i}" for i in range(20)])
    frame[rng.random((60, 20)) < 0.4] = np.nan
    frame["r18"], frame["r19"] = 0.1, np.nan
    want = frame.corr()
    for r in correlation_matrix(to_spark(spark, frame), list(frame.columns)).collect():
        expected = want.loc[r["var1"], r["var2"]]
        assert (r["corr"] is None) == bool(np.isnan(expected)) and (r["corr"] is None or abs(r["corr"] - expected) < 1e-6)


def brute_dbscan(xy: np.ndarray, eps: float, least: int):
    near = ((xy[:, None] - xy[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label = np.full(len(xy), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            stack = [i]
            while stack:
                j = stack.pop()
                if label[j] < 0:
                    label[j] = i
                    stack += [int(m) for m in np.flatnonzero(near[j] & core) if label[m] < 0]
    reach = [set(label[np.flatnonzero(near[i] & core)]) for i in range(len(xy))]
    return core, label, reach


@pytest.mark.parametrize("seed", [0, 1])
def test_dbscan_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    xy = np.vstack([
        rng.normal(size=(60, 2)) * 0.05,  # a crowded cell
        rng.normal(size=(60, 2)) * 0.6 + 3,
        np.column_stack([np.linspace(5, 9, 30), np.full(30, 5.0)]),  # a chain
        rng.uniform(-8, 12, size=(40, 2)),
    ])
    frame = pd.DataFrame({"id": np.arange(len(xy)), "x": xy[:, 0], "y": xy[:, 1]})
    got = dbscan(spark.createDataFrame(frame), 0.5, 5).toPandas().sort_values("id")
    core, label, reach = brute_dbscan(xy, 0.5, 5)
    np.testing.assert_array_equal(got["core"].to_numpy(), core)
    names = got["cluster"].to_numpy()
    pairs = {(label[i], names[i]) for i in np.flatnonzero(core)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    to_name = dict(pairs)
    for i in np.flatnonzero(~core):
        assert names[i] in {to_name[r] for r in reach[i]} if reach[i] else names[i] is None


def test_two_crowded_cells_linked_only_by_close_points(spark):
    """Both cells are full; whether they touch depends on single points."""
    side = 0.5 / math.sqrt(2)
    left = [(0.01 + 0.0001 * i, 0.1) for i in range(20)]
    for gap, linked in ((0.49, True), (0.51, False)):
        right = [(left[-1][0] + gap + 0.001 * i, 0.1) for i in range(20)]
        assert right[0][0] > side
        xy = left + right
        df = spark.createDataFrame([(i, *p) for i, p in enumerate(xy)], "id long, x double, y double")
        assert dbscan(df, 0.5, 5).select("cluster").distinct().count() == (1 if linked else 2)


def test_components_of_a_long_chain(spark):
    n = 40
    nodes = spark.createDataFrame([(f"{i:03d}",) for i in range(n + 3)], "node string")
    links = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(n - 1)] + [("040", "041")], "a string, b string")
    got = {r["node"]: r["label"] for r in connected_components(nodes, links).collect()}
    assert {got[f"{i:03d}"] for i in range(n)} == {"000"}
    assert got["041"] == "040" and got["042"] == "042"


def test_components_match_numpy(spark):
    frame = panel_frame(n=120, width=6, gaps=0.1, seed=3)
    cols = returns(frame)
    x = frame[cols].fillna(0).to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = values.argsort()[::-1]
    fitted = fit_components(to_spark(spark, frame), cols)
    variance = fitted.variance().toPandas().sort_values("component")
    np.testing.assert_allclose(variance["ratio"], values[order] / values.sum(), rtol=1e-6)
    scores = np.array(fitted.transform(to_spark(spark, frame)).toPandas().sort_values("ID")["components"].tolist())
    vectors = vectors[:, order]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), range(6)])
    np.testing.assert_allclose(scores, z @ vectors, atol=1e-6)
    needed = {r["threshold"]: r["components"] for r in components_needed(fitted.variance(), (0.5, 1.5)).collect()}
    assert needed[1.5] is None and needed[0.5] == int(np.argmax(np.cumsum(variance["ratio"]) >= 0.5)) + 1


def test_scalers(spark):
    frame = panel_frame(n=200, width=4, gaps=0.0, seed=6)
    frame["r3"] = 5.0
    cols = returns(frame)
    df, x = to_spark(spark, frame), frame[cols].to_numpy()
    got = {k: collected(fit_scaler(k, df, cols).transform(df), cols) for k in ("standard", "minmax", "robust", "quantile")}
    safe = lambda s: np.where(s == 0, 1, s)
    np.testing.assert_allclose(got["standard"], (x - x.mean(0)) / safe(x.std(0)), atol=1e-9)
    np.testing.assert_allclose(got["minmax"], (x - x.min(0)) / safe(x.max(0) - x.min(0)), atol=1e-9)
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    np.testing.assert_allclose(got["robust"], (x - q[1]) / safe(q[2] - q[0]), atol=1e-9)
    ranks = x[:, 0].argsort().argsort()
    assert (got["quantile"][ranks.argsort(), 0][1:] >= got["quantile"][ranks.argsort(), 0][:-1]).all()
    inner = got["quantile"][(ranks > 5) & (ranks < 194), 0]
    assert abs(inner.mean()) < 0.1 and 0.8 < inner.std() < 1.1


def test_samples(spark):
    df = spark.range(5000).withColumnRenamed("id", "ID")
    once = {r["ID"] for r in sample_rows(df, 100).collect()}
    again = {r["ID"] for r in sample_rows(df.repartition(7), 100).collect()}
    assert len(once) == 100 and once == again
    assert sample_rows(df, 6000).count() == 5000
    assert len(sample_columns([f"r{i}" for i in range(53)])) == 5


@pytest.fixture(scope="module")
def fitted(spark):
    """r0 decides the class, r1 helps a little, r2 is noise."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    score = x[:, 0] + 0.3 * x[:, 1]
    frame = pd.DataFrame(x, columns=["r0", "r1", "r2"])
    frame.insert(0, "ID", np.arange(400, dtype="int64"))
    frame["reod"] = np.where(score > 0.5, 1, np.where(score < -0.5, -1, 0)).astype("int32")
    data = assemble(to_spark(spark, frame), ["r0", "r1", "r2"]).cache()
    model = LogisticRegression(family="multinomial", maxIter=30).fit(data)
    return data, model


def test_builtin_and_permutation_importance(spark, fitted):
    data, model = fitted
    cols = ["r0", "r1", "r2"]
    assert [r["feature"] for r in X.builtin_importance(model, cols, spark).collect()] == cols
    forest = RandomForestClassifier(numTrees=10, seed=1).fit(data)
    assert X.builtin_importance(forest, cols, spark).first()["feature"] == "r0"
    found = X.permutation_importance(model, data, cols, repeats=3).collect()
    assert [r["feature"] for r in found] == cols
    assert found[0]["importance"] > 0.2 and abs(found[2]["importance"]) < 0.05


def test_random_partner_is_a_permutation(spark, fitted, monkeypatch):
    monkeypatch.setattr(X, "BUCKET_ROWS", 50)
    data, _ = fitted
    base = data.select("ID", F.col("ID").alias("v"))
    got = X._random_partner(base, ["v"], 3, 400).toPandas()
    assert sorted(got["partner_v"]) == sorted(got["v"]) and (got["partner_v"] != got["v"]).mean() > 0.95


def test_shapley_credits_add_up(spark, fitted):
    data, model = fitted
    few = data.where("ID < 40")
    got = X.shapley_attributions(model, few, ["r0", "r1", "r2"], permutations=4).cache()
    assert got.count() == 40 * 3 * 3
    # credits sum to 0 over the classes, and over all rows (every row is a partner as often as it is explained)
    assert got.groupBy("ID").agg(F.sum("attribution").alias("s")).agg(F.max(F.abs("s"))).first()[0] < 1e-9
    assert abs(got.where("class = 2").agg(F.sum("attribution")).first()[0]) < 1e-9
    ranking = [r["feature"] for r in X.attribution_ranking(got).collect()]
    assert ranking[0] == "r0" and ranking[-1] == "r2"
    shape = X.attribution_dependence(got, "r0", "r1").where("class = 2").toPandas()
    assert np.corrcoef(shape["value"], shape["attribution"])[0, 1] > 0.7


def test_local_surrogate(spark, fitted):
    data, model = fitted
    got = X.local_surrogate(model, data.where("ID < 5"), ["r0", "r1", "r2"], [1.0, 1.0, 1.0], samples=300).toPandas()
    top = got[(got["class"] == 2) & (got["rank"] == 1)]
    assert len(top) == 5 and (top["feature"] == "r0").all() and (top["weight"] > 0).all()


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 4))
    frame = pd.DataFrame(x, columns=[f"r{i}" for i in range(4)])
    frame.insert(0, "ID", np.arange(30, dtype="int64"))
    frame["reod"] = 0
    data = assemble(to_spark(spark, frame), [f"r{i}" for i in range(4)])
    rows = FourierFeatures(size=4000).transform(data).toPandas().sort_values("ID")
    z = np.stack([v.toArray() for v in rows["fourier"]])
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 4)
    assert np.abs(z @ z.T - kernel).max() < 0.12


def test_target_correlation_of_a_constant_column(spark):
    from panelspark.operators.correlate import target_correlations

    df = spark.createDataFrame([(1, 1.0, 5.0, 1.0), (0, 2.0, 5.0, None), (1, 3.0, 5.0, 1.0), (None, 4.0, 6.0, 2.0)], "reod int, a double, b double, c double")
    got = {r["column"]: r["corr"] for r in target_correlations(df, ["a", "b", "c"]).collect()}
    assert got["a"] == pytest.approx(0.0) and got["b"] is None and got["c"] is None
