"""From rankings to a final model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.evaluate import cross_validate, with_stratified_folds
from panelspark.operators.features import add_financial_features
from panelspark.operators.models import Entry, assemble
from panelspark.operators.pool import side_by_side
from panelspark.operators.rank import (
    pair_overlaps,
    rank_by_correlation,
    rank_by_f_value,
    rank_by_mutual_information,
    stack_rankings,
)
from panelspark.operators.reduce import components_needed, fit_components
from panelspark.operators.results import best_method
from panelspark.operators.scale import fit_scaler
from panelspark.plans.experiments import score_experiment
from panelspark.schema import KEY, TARGET, columns_except, new_columns

RANKERS = {
    "correlation": rank_by_correlation,
    "f_value": rank_by_f_value,
    "mutual_info": rank_by_mutual_information,
}


def rank_all(df: DataFrame, columns: Sequence[str], methods: Sequence[str] = tuple(RANKERS)) -> DataFrame:
    """Long rankings (method, feature, score, rank)."""
    return stack_rankings(*[RANKERS[m](df, columns) for m in methods])


def compare_methods(
    df: DataFrame, columns: Sequence[str], methods: Sequence[str] = (*RANKERS, "pca"), top_n: int = 50
) -> dict[str, DataFrame]:
    """Rankings, overlaps of every two methods and, with ``pca``, the component counts."""
    ranked = rank_all(df, columns, [m for m in methods if m in RANKERS])
    out = {"rankings": ranked, "overlaps": pair_overlaps(ranked, top_n)}
    if "pca" in methods:
        variance = fit_components(df, columns, len(columns)).variance()
        out["components"] = components_needed(variance, (0.7, 0.8, 0.9, 0.95))
    return out


def ordered_features(ranking: DataFrame) -> list[str]:
    """Feature names in rank order (one per column of the panel)."""
    return [r["feature"] for r in ranking.orderBy("rank").select("feature").collect()]


def optimise_feature_count(
    df: DataFrame, ranking: Sequence[str], entry: Entry, counts: Sequence[int] = tuple(range(5, 101, 5)),
    scaler: str | None = "standard", cv: int = 5,
) -> dict:
    """Cross-validated accuracy of the best n features for every n; the first best n wins.

    The scaler is fitted on the training part of each fold. All fits run side by side; a fold without rows doesn't count.
    """
    ranking, counts = list(ranking), list(counts)
    data = with_stratified_folds(df.select(KEY, TARGET, *ranking).na.fill(0, ranking), cv, TARGET).persist()
    rows = []
    try:
        work = [lambda n=n, i=i: _fold_score(data, ranking[:n], entry, scaler, i) for n in counts for i in range(cv)]
        found = side_by_side(df.sparkSession, work)
        for j, n in enumerate(counts):
            scores = [s for part in found[j * cv:(j + 1) * cv] for s in part]
            if not scores:
                raise ValueError("no fold has rows to score")
            mean = sum(scores) / len(scores)
            rows.append((n, mean, (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5))
    finally:
        data.unpersist()
    best = max(rows, key=lambda r: r[1])
    table = df.sparkSession.createDataFrame(rows, "n_features int, mean_cv_score double, std_cv_score double")
    return {"optimal_n_features": best[0], "best_score": best[1], "optimal_features": ranking[: best[0]], "results": table}


def _fold_score(data: DataFrame, columns: Sequence[str], entry: Entry, scaler: str | None, fold: int) -> list[float]:
    fitted = fit_scaler(scaler, data.where(F.col("fold") != fold), columns)
    scaled = data if fitted is None else fitted.transform(data)
    frame = assemble(scaled, list(columns), keep=(KEY, "fold"))
    # cross_validate over one fold: it trains where fold != 0 and scores where fold = 0.
    one = frame.withColumn("fold", (F.col("fold") != fold).cast("int"))
    return cross_validate(entry.make, one, 1).scores


def choose_method(optimised: Mapping[str, dict], fallback: DataFrame | None = None) -> tuple[str | None, list[str]]:
    """(method, features) with the best score; without any result the first 20 of ``fallback``."""
    if optimised:
        spark = next(iter(optimised.values()))["results"].sparkSession
        scores = spark.createDataFrame([(m, r["best_score"]) for m, r in optimised.items()], "method string, best_score double")
        winner = best_method(scores).first()
        if winner is not None:
            return winner["method"], optimised[winner["method"]]["optimal_features"]
    return None, [] if fallback is None else ordered_features(fallback.where(F.col("rank") <= 20))


def final_models(train: DataFrame, test: DataFrame, features: Sequence[str], entry: Entry) -> DataFrame:
    """(variant, n_features, accuracy, delta): the selected features, then with the financial ones added."""
    base, _, _ = score_experiment(train, test, entry, "standard", features)
    rich_train, rich_test = add_financial_features(train), add_financial_features(test)
    extra = [c for c in new_columns(train, rich_train) if c not in features]
    rich, _, _ = score_experiment(rich_train, rich_test, entry, "standard", [*features, *extra])
    rows = [
        ("selected", len(features), base["accuracy"], 0.0),
        ("selected + financial", len(features) + len(extra), rich["accuracy"], rich["accuracy"] - base["accuracy"]),
    ]
    return train.sparkSession.createDataFrame(rows, "variant string, n_features int, accuracy double, delta double")


def candidate_columns(df: DataFrame) -> list[str]:
    """Everything but key and label."""
    return columns_except(df, (KEY, TARGET))
