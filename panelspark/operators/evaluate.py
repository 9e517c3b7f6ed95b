"""Classification metrics, cross-validation, search and learning curves."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.sketch import hash_fold, hash_unit
from panelspark.operators.models import LABEL, PREDICTION, index_class
from panelspark.operators.order import free_names, rank_within
from panelspark.operators.pool import side_by_side
from panelspark.schema import CLASSES, KEY

# --- metrics from predictions -----------------------------------------------------------------


def confusion_counts(predictions: DataFrame, by: Sequence[str] = (), label: str = "actual", pred: str = "predicted") -> DataFrame:
    """(by..., actual, predicted, n). All metrics below start from these few rows."""
    return predictions.groupBy(*by, F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., class, precision, recall, f1, support); a metric without any case is 0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("actual_n"), F.lit(0).cast("long").alias("pred_n"), hit.alias("hit_n")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("actual_n"), F.col("n").alias("pred_n"), F.lit(0).cast("long").alias("hit_n")),
    )
    sums = counts.select(*by, F.explode(roles).alias("e")).groupBy(*by, F.col("e.class").alias("class")).agg(
        F.sum("e.hit_n").alias("hits"), F.sum("e.actual_n").alias("support"), F.sum("e.pred_n").alias("predicted_n")
    )
    precision = F.coalesce(F.try_divide("hits", "predicted_n"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    report = sums.select(*by, "class", precision.alias("precision"), recall.alias("recall"), "support", "hits")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return report.select(*by, "class", "precision", "recall", f1.alias("f1"), "support", "hits")


def summary_metrics(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by``: accuracy, macro and weighted averages, precision and recall per class."""
    n = F.sum("support")
    averages = [
        f.alias(f"{m}_{kind}")
        for m in ("precision", "recall", "f1")
        for kind, f in (
            ("macro", F.avg(m)),
            ("weighted", F.try_divide(F.sum(F.col(m) * F.col("support")), n)),
        )
    ]
    per_class = [
        F.coalesce(F.max(F.when(F.col("class") == c, F.col(m))), F.lit(0.0)).alias(f"class_{c}_{m}")
        for m in ("precision", "recall")
        for c in CLASSES
    ]
    return report.groupBy(*by).agg(F.try_divide(F.sum("hits"), n).alias("accuracy"), *averages, *per_class)


def classification_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return summary_metrics(class_report(confusion_counts(predictions, by), by), by)


def confusion_matrix(predictions: DataFrame, classes: Sequence[int] = CLASSES, normalise: bool = False) -> DataFrame:
    """(actual, one column per predicted class), counts or shares of the row."""
    counts = confusion_counts(predictions)
    table = counts.groupBy("actual").pivot("predicted", list(classes)).agg(F.sum("n")).na.fill(0)
    if not normalise:
        return table
    total = sum((F.col(f"`{c}`") for c in classes), F.lit(0))
    return table.select("actual", *[F.try_divide(F.col(f"`{c}`"), total).alias(str(c)) for c in classes])


def prediction_shares(predictions: DataFrame, column: str = "predicted", classes: Sequence[int] = CLASSES) -> DataFrame:
    """(class, share) of one label column."""
    shares = predictions.agg(F.array(*[F.avg((F.col(column) == c).cast("int")) for c in classes]).alias("s"))
    each = shares.select(F.posexplode("s").alias("pos", "share"))
    return each.select(F.get(F.array(*map(F.lit, classes)), F.col("pos")).alias("class"), "share")


def labelled(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., actual, predicted) in class values from a model's output."""
    return scored.select(*keep, index_class(F.col(LABEL)).alias("actual"), index_class(F.col(PREDICTION)).alias("predicted"))


def accuracy(scored: DataFrame) -> float | None:
    return scored.agg(F.avg((F.col(LABEL) == F.col(PREDICTION)).cast("double"))).first()[0]


# --- cross-validation -------------------------------------------------------------------------

Factory = Callable[[], object]


def with_folds(df: DataFrame, k: int = 5, key: str = KEY, seed: int = 42) -> DataFrame:
    """Adds ``fold``. A hash of the key spreads every class evenly without ordering any class in one task."""
    return df.withColumn("fold", hash_fold(F.col(key), k, seed))


def with_stratified_folds(df: DataFrame, k: int = 5, label: str = LABEL, key: str = KEY, seed: int = 42) -> DataFrame:
    """Adds ``fold``: the rows of each class, in an order that a hash of the key gives, are dealt to the folds in turn, so a
    class's numbers of rows by fold differ by one at most. Places are exact, yet no class is ordered in one task."""
    hashed, place, total = free_names(df, "hashed", "place", "total")
    placed = rank_within(df.withColumn(hashed, F.xxhash64(F.lit(seed), F.col(key))), [label], [hashed, key], place, total)
    return placed.withColumn("fold", (F.col(place) % k).cast("int")).drop(hashed, place, total)


def _for_fits(folded: DataFrame) -> DataFrame:
    """In at most as many parts as tasks run at a time: each step of a fit sends something to the driver for every part."""
    return folded.coalesce(max(1, folded.sparkSession.sparkContext.defaultParallelism))


def _mean_std(values: Sequence[float]) -> tuple[float, float]:
    if not values:
        raise ValueError("no fold has rows to score")
    mean = sum(values) / len(values)
    return mean, math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


@dataclass
class FoldScores:
    scores: list[float] = field(default_factory=list)
    train_scores: list[float] = field(default_factory=list)

    @property
    def mean(self) -> float:
        return _mean_std(self.scores)[0]

    @property
    def std(self) -> float:
        return _mean_std(self.scores)[1]


def _score_fold(make: Factory, folded: DataFrame, fold: int, train_filter, score_train: bool) -> tuple[float | None, float | None]:
    train = folded.where(F.col("fold") != fold)
    if train_filter is not None:
        train = train.where(train_filter)
    model = make().fit(train)
    own = accuracy(model.transform(folded.where(F.col("fold") == fold)))
    return own, accuracy(model.transform(train)) if score_train else None


def cross_validate_all(jobs: Sequence[tuple[Factory, Column | None]], folded: DataFrame, k: int = 5, score_train: bool = False) -> list[FoldScores]:
    """Fold accuracies of each (make, filter of the training rows), all fits of all of them side by side."""
    work = [lambda m=make, f=only, i=i: _score_fold(m, folded, i, f, score_train) for make, only in jobs for i in range(k)]
    found = side_by_side(folded.sparkSession, work)
    results = []
    for j in range(len(jobs)):
        pairs = found[j * k:(j + 1) * k]
        # A fold without rows has no accuracy and is left out of the mean.
        results.append(FoldScores([s for s, _ in pairs if s is not None], [t for _, t in pairs if t is not None]))
    return results


def cross_validate(make: Factory, folded: DataFrame, k: int = 5, train_filter=None, score_train: bool = False) -> FoldScores:
    """Accuracy of a fresh model per fold. ``folded`` has features, label and fold; cache it beforehand."""
    return cross_validate_all([(make, train_filter)], folded, k, score_train)[0]


def evaluate_performance(make: Factory, train: DataFrame, test: DataFrame, cv: int = 5) -> tuple[dict, DataFrame]:
    """Cross-validate on train, fit on all of it, score test. Returns (metrics with timings, predictions)."""
    folded = with_stratified_folds(train, cv).persist()
    try:
        t0 = time.perf_counter()
        folds = cross_validate(make, folded, cv)
        t1 = time.perf_counter()
        model = make().fit(folded)
        t2 = time.perf_counter()
        predictions = labelled(model.transform(test), [c for c in (KEY,) if c in test.columns])
        metrics = classification_metrics(predictions).first().asDict()
        t3 = time.perf_counter()
    finally:
        folded.unpersist()
    return (
        {
            "cv_mean_accuracy": folds.mean,
            "cv_std_accuracy": folds.std,
            "test_accuracy": metrics.pop("accuracy"),
            **metrics,
            "cv_time": t1 - t0,
            "train_time": t2 - t1,
            "pred_time": t3 - t2,
            "total_time": t3 - t0,
        },
        predictions,
    )


def parameter_draws(grid: Mapping[str, Sequence], n_iter: int | None = 15, seed: int = 42) -> list[dict]:
    """All combinations of a grid, or ``n_iter`` different ones of them."""
    names = list(grid)
    combos = [dict(zip(names, values)) for values in product(*grid.values())]
    if n_iter is None or n_iter >= len(combos):
        return combos
    return random.Random(seed).sample(combos, n_iter)


def search_parameters(
    make: Callable[..., object], grid: Mapping[str, Sequence], train: DataFrame, cv: int = 4,
    n_iter: int = 15, use_random: bool = True,
) -> dict:
    """Best parameters by mean fold accuracy; ``make(**params)`` builds a model.

    ``trials`` is the table of all draws.
    """
    started = time.perf_counter()
    folded = _for_fits(with_stratified_folds(train, cv)).persist()
    try:
        draws = parameter_draws(grid, n_iter if use_random else None)
        found = cross_validate_all([(lambda p=params: make(**p), None) for params in draws], folded, cv)
        trials = [(params, folds.mean, folds.std) for params, folds in zip(draws, found)]
        best = max(trials, key=lambda t: t[1])
        model = make(**best[0]).fit(folded)
    finally:
        folded.unpersist()
    table = train.sparkSession.createDataFrame(
        [(i, ", ".join(f"{k}={v}" for k, v in p.items()), m, s) for i, (p, m, s) in enumerate(trials)],
        "trial int, params string, mean_score double, std_score double",
    )
    return {
        "best_model": model, "best_params": best[0], "best_score": best[1],
        "optimization_time": time.perf_counter() - started, "trials": table,
    }


def learning_curve(
    make: Factory, train: DataFrame, cv: int = 5, shares: Sequence[float] = tuple(i / 10 for i in range(1, 11))
) -> DataFrame:
    """(share, train_mean, train_std, test_mean, test_std). Larger training sets contain the smaller ones."""
    folded = _for_fits(with_stratified_folds(train, cv).withColumn("__u", hash_unit(F.col(KEY), seed=7))).persist()
    try:
        found = cross_validate_all([(make, F.col("__u") < share) for share in shares], folded, cv, score_train=True)
        rows = [(float(share), *_mean_std(folds.train_scores), *_mean_std(folds.scores)) for share, folds in zip(shares, found)]
    finally:
        folded.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "share double, train_mean double, train_std double, test_mean double, test_std double"
    )
