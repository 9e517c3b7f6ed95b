"""Tables of experiment results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.schema import CLASSES

# Columns of a result summary and of the result table.
SUMMARY_COLUMNS = (
    "dataset", "dataset_description", "model", "normalize_by_row", "features_added",
    "accuracy", "f1_weighted", "total_time",
)

_REPORT = T.MapType(
    T.StringType(),
    T.StructType([T.StructField(m, T.DoubleType()) for m in ("precision", "recall", "f1")] + [T.StructField("support", T.LongType())]),
)
TRACKER = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("dataset", "dataset_description", "model", "model_description")]
    + [
        T.StructField("features_added", T.BooleanType()),
        T.StructField("feature_sets", T.ArrayType(T.StringType())),
        T.StructField("normalize_by_row", T.BooleanType()),
        T.StructField("scaler", T.StringType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted")]
    + [T.StructField(f"class_{c}_{m}", T.DoubleType()) for m in ("precision", "recall") for c in CLASSES]
    + [T.StructField("report", _REPORT)]
    + [T.StructField(f"{c}_time", T.DoubleType()) for c in ("load", "train", "pred", "total")]
)


def append_results(tracker: DataFrame, more: DataFrame) -> DataFrame:
    """Add result rows; columns one side lacks are NULL there."""
    return tracker.unionByName(more, allowMissingColumns=True)


def top_results(results: DataFrame, score: str = "accuracy", n: int = 10, ties: Sequence[str] = ("dataset", "model")) -> DataFrame:
    return results.orderBy(F.col(score).desc(), *[t for t in ties if t in results.columns]).limit(n)


def results_summary(results: DataFrame, top_n: int = 10, ties: Sequence[str] = ("dataset", "model")) -> DataFrame:
    """The best rows with the usual columns, as far as they exist."""
    return top_results(results.select(*[c for c in SUMMARY_COLUMNS if c in results.columns]), "accuracy", top_n, ties)


def group_summary(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, deviation and best accuracy and f1, mean and least time per group."""
    stats = [
        f(c).alias(f"{c}_{name}")
        for c in ("accuracy", "f1_weighted")
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max))
    ]
    times = [F.avg("total_time").alias("total_time_mean"), F.min("total_time").alias("total_time_min")]
    return results.groupBy(*[c for c in by if c in results.columns]).agg(*stats, *times)


def best_result(results: DataFrame, score: str = "accuracy", ties: Sequence[str] = ("dataset", "model")) -> DataFrame:
    return top_results(results, score, 1, ties)


def mean_scores(results: DataFrame, by: Sequence[str], score: str = "accuracy") -> DataFrame:
    """Bar heights of a grouped bar chart."""
    return results.groupBy(*by).agg(F.avg(score).alias(score))


def best_pivot(results: DataFrame, models: Sequence[str], score: str = "accuracy") -> DataFrame:
    """(dataset, best score per model)."""
    return results.groupBy("dataset").pivot("model", list(models)).agg(F.max(score))


def improvements(results: DataFrame, flag: str, keys: Sequence[str], score: str = "accuracy") -> DataFrame:
    """(keys..., without, with, improvement) for runs that differ in one boolean only."""
    sides = results.groupBy(*keys).agg(
        F.max(F.when(~F.col(flag), F.col(score))).alias("without"),
        F.max(F.when(F.col(flag), F.col(score))).alias("with"),
    )
    return sides.where(F.col("without").isNotNull() & F.col("with").isNotNull()).withColumn(
        "improvement", F.col("with") - F.col("without")
    )


def best_method(scores: DataFrame) -> DataFrame:
    """The row with the highest ``best_score``; the first method name on ties."""
    return scores.where(F.col("best_score").isNotNull()).orderBy(F.col("best_score").desc(), "method").limit(1)


def importance_share(importance: DataFrame, top_n: int = 10) -> DataFrame:
    """Summed importance of the first features."""
    top = importance.orderBy(F.col("importance").desc(), "feature").limit(top_n)
    return top.agg(F.sum("importance").alias("importance"))
