import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import evaluate as E
from panelspark.operators import models as M
from panelspark.operators import results as T
from panelspark.plans import datasets as D
from panelspark.plans import experiments as V
from panelspark.plans import selection as S
from panelspark.schema import panel_schema
from panelspark.sources.derived import split_by_key
from panelspark.sources.registry import Registry
from panelspark.sources.tables import read_csv, write_csv
from tests.data import collected, panel_frame, returns, to_spark

SMALL = {"logistic": M.Entry(lambda: M.multinomial_logistic(30, 0.01), "small"), "forest": M.Entry(lambda: M.random_forest(8, 4), "small")}


@pytest.fixture(scope="module")
def sides(spark):
    df = to_spark(spark, panel_frame(n=300, width=12, gaps=0.1, seed=21)).cache()
    return split_by_key(df)


@pytest.fixture(scope="module")
def registry(spark, sides, tmp_path_factory):
    made = Registry(str(tmp_path_factory.mktemp("registry")))
    D.build_datasets(made, *sides, ["raw", "ffbf"])
    return made


def test_csv_keeps_values_ids_and_gaps(spark, tmp_path):
    frame = panel_frame(n=20)
    frame.loc[0, "ID"] = 2**60 + 1
    write_csv(to_spark(spark, frame), str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"), panel_schema(with_target=True))
    assert back.columns == list(frame.columns) and back.where(F.col("ID") == 2**60 + 1).count() == 1
    cols = returns(frame)
    np.testing.assert_allclose(collected(back, cols), frame.sort_values("ID")[cols].to_numpy(), equal_nan=True)


def test_csv_marks_for_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,reod\n1,\n2,NA\n3,nan\n4,-1\n5, 1.0 \n")
    from panelspark.schema import label_schema

    got = {r["ID"]: r["reod"] for r in read_csv(spark, str(tmp_path / "a.csv"), label_schema()).collect()}
    assert got == {1: None, 2: None, 3: None, 4: -1, 5: 1}


def test_registry(spark, registry):
    assert len(Registry("/x").keys()) == 12
    with pytest.raises(ValueError):
        registry["nothing"]
    with pytest.warns(UserWarning):
        assert registry.register("knn", "a", "b", "other")
    loaded = D.load_datasets(spark, registry, ["raw", "ffbf", "bfff"])
    assert set(loaded) == {"raw", "ffbf"}  # bfff was never written
    sizes, shares = D.profile_datasets(loaded)
    assert sizes.count() == 4 and sizes.where("strategy = 'ffbf'").agg(F.sum("n_nulls")).first()[0] == 0
    assert shares.where("strategy = 'raw'").agg(F.sum("percent")).first()[0] == pytest.approx(100)
    registry.create_views(spark, "raw")
    assert spark.sql("SELECT count(*) FROM raw_train").first()[0] > 0


def test_precomputed_features(spark, registry):
    assert D.precompute_features(spark, registry, ["raw", "bfff"]) == ["raw_with_features"]
    train, _ = registry.read(spark, "raw_with_features")
    assert "r_mean" in train.columns
    assert V.resolve_key(registry, "raw", True) == ("raw_with_features", True)
    with pytest.raises(ValueError):
        V.resolve_key(registry, "nothing", True)


def test_datasets_and_their_features_are_made_side_by_side(spark, sides, tmp_path, monkeypatch):
    """Each piece waits for the others to have begun; one after the other, the first would wait in vain."""
    made, inner = Registry(str(tmp_path)), D.add_features
    begun, featured = threading.Barrier(4), threading.Barrier(2)

    def imputer(df):
        begun.wait(60)
        return df

    def features(df):
        featured.wait(60)
        return inner(df)

    monkeypatch.setattr(D, "IMPUTERS", {"raw": imputer, "ffbf": imputer})
    D.build_datasets(made, *sides, ["raw", "ffbf"])
    for key in ("raw", "ffbf"):
        assert [df.count() for df in made.read(spark, key)] == [df.count() for df in sides]
    monkeypatch.setattr(D, "add_features", features)
    failed = {}
    assert D.precompute_features(spark, made, ["ffbf", "raw", "ffbf"], failed) == ["ffbf_with_features", "raw_with_features", "ffbf_with_features"]
    assert not failed and "r_mean" in made.read(spark, "ffbf_with_features")[1].columns


def test_metrics_against_hand_counts(spark):
    rows = [(1, 1)] * 5 + [(1, 0)] * 2 + [(0, 0)] * 3 + [(0, 1)] + [(-1, 0)] * 4
    df = spark.createDataFrame(rows, "actual int, predicted int")
    report = {r["class"]: r for r in E.class_report(E.confusion_counts(df)).collect()}
    assert report[1]["precision"] == pytest.approx(5 / 6) and report[1]["recall"] == pytest.approx(5 / 7)
    assert report[-1]["precision"] == report[-1]["recall"] == report[-1]["f1"] == 0.0 and report[-1]["support"] == 4
    m = E.classification_metrics(df).first()
    assert m["accuracy"] == pytest.approx(8 / 15)
    assert m["recall_weighted"] == pytest.approx(m["accuracy"]) and m["class_0_precision"] == pytest.approx(3 / 9)
    table = E.confusion_matrix(df).toPandas()
    assert table[["-1", "0", "1"]].to_numpy().sum() == len(rows)
    shares = E.confusion_matrix(df, normalise=True).toPandas()[["-1", "0", "1"]].to_numpy()
    np.testing.assert_allclose(shares.sum(axis=1), 1.0)


def test_experiment_beats_the_majority_class(spark, registry, sides):
    row = V.run_experiment(spark, registry, "raw", "logistic", models=SMALL, normalize_by_row=False)
    assert row.schema == T.TRACKER
    got = row.first()
    majority = sides[1].groupBy("reod").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert got["accuracy"] > majority + 0.1 and got["features_added"] and set(got["report"]) <= {"-1", "0", "1"}
    assert got["total_time"] == pytest.approx(got["load_time"] + got["train_time"] + got["pred_time"])


def test_sweep_and_result_tables(spark, registry):
    results = V.sweep(spark, registry, ["raw"], ["forest"], (False, True), ("standard", "robust"), models=SMALL).cache()
    assert results.count() == 4
    assert T.improvements(results, "features_added", ["dataset", "model", "scaler"]).count() == 2
    both = T.append_results(results, results.drop("report"))
    assert both.count() == 8 and both.where("report IS NULL").count() == 4
    assert T.results_summary(results, 2).count() == 2


def test_feature_count_and_final_models(spark, sides):
    train, test = sides
    cols = returns(panel_frame(width=12))
    ranking = S.ordered_features(S.RANKERS["correlation"](train, cols))
    best = S.optimise_feature_count(train, ranking, SMALL["logistic"], (1, 12), cv=2)
    assert best["optimal_n_features"] == 12 and best["results"].count() == 2
    method, features = S.choose_method({"correlation": best})
    assert method == "correlation" and features == ranking
    fallback = S.choose_method({}, S.RANKERS["correlation"](train, cols))
    assert fallback[0] is None and fallback[1] == ranking[:20]
    table = S.final_models(train, test, ranking[:4], SMALL["forest"]).collect()
    assert [r["n_features"] for r in table] == [4, 7]


def test_compare_methods(spark, sides):
    cols = returns(panel_frame(width=12))
    out = S.compare_methods(sides[0], cols, top_n=5)
    assert out["rankings"].count() == 36 and out["overlaps"].count() == 3 and out["components"].count() == 4


def test_cross_validation_search_and_curve(spark, sides):
    cols = returns(panel_frame(width=12))
    train, test, _ = V.prepare_features(*sides, cols)
    metrics, predictions = E.evaluate_performance(SMALL["logistic"].make, train, test, cv=3)
    assert metrics["cv_mean_accuracy"] > 0.5 and predictions.count() == test.count()
    found = E.search_parameters(M.random_forest, {"n_trees": [2, 6], "max_depth": [1, 4]}, train, cv=2, use_random=False)
    assert found["trials"].count() == 4 and found["best_score"] == found["trials"].agg(F.max("mean_score")).first()[0]
    curve = E.learning_curve(SMALL["logistic"].make, train, 2, (0.3, 1.0)).collect()
    assert len(curve) == 2 and all(0 < r["test_mean"] <= 1 for r in curve)
    draws = E.parameter_draws({"a": list(range(10)), "b": list(range(10))}, 15)
    assert len({tuple(d.items()) for d in draws}) == 15


def test_catalogues_make_fresh_models():
    for catalogue in (M.baseline_models(), M.advanced_models(), M.unsupervised_models()):
        assert all(e.description for e in catalogue.values())
    assert set(M.baseline_models()) == {"xgboost_baseline", "xgboost_tuned", "rf_baseline", "logistic"}
    assert set(M.unsupervised_models()) == {"kmeans", "dbscan", "agg_clustering"}


def test_models_are_fresh(spark):
    entry = M.baseline_models()["xgboost_tuned"]
    first, second = entry.make(), entry.make()
    assert first is not second and first.growth.rounds == 300


def test_boosted_trees_learn(spark, sides):
    cols = returns(panel_frame(width=12))
    entry = M.Entry(lambda: M.boosted_trees(3, 3, 0.3), "few")
    metrics, _, _ = V.score_experiment(*sides, entry, "standard", cols)
    assert metrics["accuracy"] > 0.5
