"""Running and comparing classification experiments."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.evaluate import class_report, confusion_counts, labelled, summary_metrics
from panelspark.operators.explain import builtin_importance
from panelspark.operators.features import add_features, add_signature, normalise_rows
from panelspark.operators.models import Entry, all_models, assemble, signature_model
from panelspark.operators.pool import side_by_side
from panelspark.operators.results import TRACKER
from panelspark.operators.scale import fit_scaler
from panelspark.schema import KEY, TARGET, columns_except
from panelspark.sources.registry import FEATURE_SUFFIX, Registry
from panelspark.sources.scratch import stored

NOT_FEATURES = (KEY, TARGET)


def prepare_features(
    train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None, scaler: str | None = "standard"
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Zero-filled, scaled (fitted on train) and assembled (key, features, label) frames."""
    columns = columns_except(train, NOT_FEATURES) if columns is None else list(columns)
    train, test = (df.select(KEY, TARGET, *columns).na.fill(0, columns) for df in (train, test))
    fitted = fit_scaler(scaler, train, columns)
    if fitted is not None:
        train, test = fitted.transform(train), fitted.transform(test)
    return assemble(train, columns), assemble(test, columns), columns


def resolve_key(registry: Registry, key: str, precomputed: bool) -> tuple[str, bool]:
    """The dataset to read and whether it already has features."""
    if precomputed and key + FEATURE_SUFFIX in registry:
        return key + FEATURE_SUFFIX, True
    registry[key]
    return key, False


def score_experiment(
    train: DataFrame, test: DataFrame, entry: Entry, scaler: str | None = "standard", columns: Sequence[str] | None = None
) -> tuple[dict, object, DataFrame]:
    """Fit on train, score test: (metrics, report and timings, model, predictions)."""
    fit_frame, test_frame, _ = prepare_features(train, test, columns, scaler)
    fit_frame = fit_frame.persist()
    try:
        t0 = time.perf_counter()
        model = entry.make().fit(fit_frame)
        t1 = time.perf_counter()
    finally:
        fit_frame.unpersist()
    predictions = labelled(model.transform(test_frame), [KEY])
    counts = confusion_counts(predictions).persist()
    try:
        report = class_report(counts)
        metrics = summary_metrics(report).first().asDict()
        # One row per class.
        classes = {
            str(r["class"]): {m: r[m] for m in ("precision", "recall", "f1", "support")} for r in report.collect()
        }
    finally:
        counts.unpersist()
    t2 = time.perf_counter()
    return {**metrics, "report": classes, "train_time": t1 - t0, "pred_time": t2 - t1}, model, predictions


def run_experiment(
    spark: SparkSession,
    registry: Registry,
    dataset_key: str,
    model_key: str,
    add_feat: bool = True,
    feature_sets: Sequence[str] | None = None,
    normalize_by_row: bool = False,
    use_precomputed_features: bool = False,
    scaler: str | None = "standard",
    models: Mapping[str, Entry] | None = None,
) -> DataFrame:
    """One result row (see :data:`panelspark.operators.results.TRACKER`)."""
    started = time.perf_counter()
    actual, has_features = resolve_key(registry, dataset_key, use_precomputed_features)
    train, test = registry.read(spark, actual)
    load_time = time.perf_counter() - started
    entry = (models or all_models())[model_key]
    row = _experiment_row(
        train, test, entry, add_feat and not has_features, feature_sets, normalize_by_row, scaler,
        {
            "dataset": dataset_key,
            "dataset_description": registry[actual].description,
            "model": model_key,
            "model_description": entry.description,
            "features_added": add_feat or has_features,
            "load_time": load_time,
        },
    )
    return spark.createDataFrame([row], TRACKER)


def _experiment_row(train, test, entry, add_feat, feature_sets, normalize_by_row, scaler, names) -> Row:
    if add_feat:
        # The scaler and the fit both read the training side, so its features are worked out before.
        train, test = stored(add_features(train, feature_sets), "featured"), add_features(test, feature_sets)
    if normalize_by_row:
        train, test = normalise_rows(train), normalise_rows(test)
    metrics, _, _ = score_experiment(train, test, entry, scaler)
    values = {
        **metrics,
        **names,
        "feature_sets": list(feature_sets) if feature_sets is not None else None,
        "normalize_by_row": normalize_by_row,
        "scaler": scaler,
    }
    values["total_time"] = values["load_time"] + values["train_time"] + values["pred_time"]
    return Row(**{name: values[name] for name in TRACKER.fieldNames()})


# (features added, rows normalised): as it is, with features, with features and rows normalised.
SETTINGS = ((False, False), (True, False), (True, True))


def sweep(
    spark: SparkSession,
    registry: Registry,
    dataset_keys: Sequence[str],
    model_keys: Sequence[str],
    add_feat: Sequence[bool] = (False, True),
    scalers: Sequence[str | None] = ("standard",),
    normalize: Sequence[bool] = (False,),
    models: Mapping[str, Entry] | None = None,
    settings: Sequence[tuple[bool, bool]] | None = None,
) -> DataFrame:
    """All combinations as result rows; ``settings`` lists pairs of ``add_feat`` and ``normalize`` instead of all of them. Every run
    gets a fresh scaler and model; runs go side by side."""
    runs = [(key, model, feat, scaler, norm) for key, model, feat, scaler, norm in product(dataset_keys, model_keys, (False, True), scalers, (False, True))
            if ((feat, norm) in settings if settings is not None else feat in add_feat and norm in normalize)]

    def one(key, model, feat, scaler, norm):
        return run_experiment(spark, registry, key, model, feat, normalize_by_row=norm, scaler=scaler, models=models).collect()

    # A fit may be one long task, so as many runs as cores go at a time.
    found = side_by_side(spark, [lambda r=r: one(*r) for r in runs], max(1, min(len(runs), spark.sparkContext.defaultParallelism)))
    return spark.createDataFrame([row for rows in found for row in rows], TRACKER)


ABLATION = {
    "all": None,
    "basic_stats": ("basic_stats",),
    "technical": ("technical",),
    "basic_stats, technical": ("basic_stats", "technical"),
}


def evaluate_feature_sets(
    train: DataFrame, test: DataFrame, entry: Entry, scaler: str | None = "standard"
) -> DataFrame:
    """(feature_set, accuracy, f1_weighted, train_time, total_time), best first, with a run without features."""
    def one(name: str, sets: Sequence[str] | None) -> tuple:
        started = time.perf_counter()
        sides = (train, test) if name == "none" else (add_features(train, sets), add_features(test, sets))
        # Features are worked out once, not in each pass of the scaler and the fit.
        sides = [stored(df, "featured") for df in sides]
        metrics, _, _ = score_experiment(*sides, entry, scaler)
        return name, metrics["accuracy"], metrics["f1_weighted"], metrics["train_time"], time.perf_counter() - started

    work = [lambda n=name, s=sets: one(n, s) for name, sets in [*ABLATION.items(), ("none", ())]]
    rows = side_by_side(train.sparkSession, work)
    table = train.sparkSession.createDataFrame(
        rows, "feature_set string, accuracy double, f1_weighted double, train_time double, total_time double"
    )
    return table.orderBy(F.col("accuracy").desc(), "feature_set")


def feature_importance(train: DataFrame, entry: Entry, top_n: int = 20) -> tuple[DataFrame, object]:
    """Fit on all features but the identifiers and rank them by the model's own importance."""
    columns = columns_except(train, (*NOT_FEATURES, "day", "equity"))
    model = entry.make().fit(assemble(train, columns))
    return builtin_importance(model, columns, train.sparkSession).limit(top_n), model


SIGNATURE_COLUMNS = ("s1", "s2", "s11", "s12", "s21", "s22", "null_count")


def signature_experiment(train: DataFrame, test: DataFrame, entry: Entry | None = None) -> tuple[dict, object, DataFrame]:
    """Model on path signatures and the number of gaps."""
    entry = entry or Entry(signature_model, "boosted trees on path signatures")
    return score_experiment(add_signature(train), add_signature(test), entry, None, SIGNATURE_COLUMNS)
