from panelspark.operators import evaluate as E
from panelspark.operators import models as M
from panelspark.plans import experiments as V
from panelspark.sources.registry import Registry
from tests.data import panel_frame, to_spark


def test_fits_run_over_few_parts(spark):
    """What a step of a fit sends to the driver does not grow with the parts of the table."""
    folded = E._for_fits(spark.range(1000).repartition(60))
    assert folded.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism and folded.count() == 1000


def test_features_of_each_set_are_worked_out_once(spark, monkeypatch):
    """The scaler, the fit and the scoring read stored features, two tables a set."""
    seen, inner = [], V.stored
    monkeypatch.setattr(V, "stored", lambda df, name: seen.append(name) or inner(df, name))
    df = to_spark(spark, panel_frame(n=60, gaps=0.1))
    entry = M.Entry(lambda: M.random_forest(3, 2), "small")
    found = V.evaluate_feature_sets(df.where("ID % 5 <> 0"), df.where("ID % 5 = 0"), entry).collect()
    assert len(found) == 5 and len(seen) == 10
    assert sorted(r["feature_set"] for r in found) == sorted([*V.ABLATION, "none"])


def test_an_experiment_works_out_its_features_once(spark, tmp_path, monkeypatch):
    """Scaler and fit read the stored training side."""
    df = to_spark(spark, panel_frame(n=60, gaps=0.1))
    made = Registry(str(tmp_path))
    made.write("raw", df.where("ID % 5 <> 0"), df.where("ID % 5 = 0"))
    seen, inner = [], V.stored
    monkeypatch.setattr(V, "stored", lambda df, name: seen.append(name) or inner(df, name))
    small = {"forest": M.Entry(lambda: M.random_forest(3, 2), "small")}
    assert V.sweep(spark, made, ["raw"], ["forest"], models=small).count() == 2
    assert seen == ["featured"]
