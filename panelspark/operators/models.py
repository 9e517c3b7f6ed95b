"""Model catalogues. Every entry makes a fresh, unfitted estimator, so no state leaks between runs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.balls import dbscan_vectors
from panelspark.operators.boosting import BoostedTrees, Growth
from panelspark.operators.kernel import KernelMachine
from panelspark.operators.ward import WardClustering
from panelspark.schema import CLASSES, KEY, TARGET, quoted

SEED = 42
FEATURES, LABEL, PREDICTION = "features", "label", "prediction"


# --- labels and feature vectors ---------------------------------------------------------------


def class_index(target: Column) -> Column:
    """-1, 0, 1 -> 0, 1, 2; other values become NULL."""
    table = F.create_map(*[F.lit(v) for i, c in enumerate(CLASSES) for v in (c, float(i))])
    return F.try_element_at(table, target.cast("int"))


def index_class(index: Column) -> Column:
    """0, 1, 2 -> -1, 0, 1; other values become NULL."""
    table = F.create_map(*[F.lit(v) for i, c in enumerate(CLASSES) for v in (i, c)])
    return F.try_element_at(table, index.cast("int"))


def replace_labels(df: DataFrame, mapping: dict[int, int], target: str = TARGET) -> DataFrame:
    """Map labels; values that are not in the mapping are kept."""
    return df.replace(mapping, subset=[target])


def assemble(df: DataFrame, columns: list[str], target: str = TARGET, keep: tuple[str, ...] = (KEY,)) -> DataFrame:
    """(keep..., features, label) with missing features as 0."""
    filled = df.select(
        *[k for k in keep if k in df.columns],
        class_index(F.col(target)).alias(LABEL),
        *[F.expr(f"coalesce(double({quoted(c)}), 0D) AS __f{i}") for i, c in enumerate(columns)],
    )
    names = [f"__f{i}" for i in range(len(columns))]
    return VectorAssembler(inputCols=names, outputCol=FEATURES).transform(filled).drop(*names)


# --- building blocks --------------------------------------------------------------------------


class FourierFeatures(Transformer, HasInputCol, HasOutputCol):
    """Random cosine features whose dot products approximate an RBF kernel (Rahimi and Recht, 2007)."""

    @keyword_only
    def __init__(self, *, inputCol: str = FEATURES, outputCol: str = "fourier", size: int = 128, seed: int = SEED):
        super().__init__()
        self.size, self.seed = size, seed
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        size, seed = self.size, self.seed

        @F.pandas_udf("array<double>")
        def cosines(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if not len(batch):
                    yield pd.Series([], dtype=object)
                    continue
                x = np.stack(batch.to_numpy())
                rng = np.random.default_rng(seed)
                # gamma = 1 / number of features, for standardised input
                weights = rng.normal(scale=math.sqrt(2.0 / x.shape[1]), size=(x.shape[1], size))
                phase = rng.uniform(0.0, 2.0 * math.pi, size)
                yield pd.Series(list(math.sqrt(2.0 / size) * np.cos(x @ weights + phase)))

        values = cosines(vector_to_array(F.col(self.getInputCol())))
        return df.withColumn(self.getOutputCol(), array_to_vector(values))


class BestKMeans(Estimator):
    """k-means from several seeds; the run with the lowest cost wins."""

    def __init__(self, k: int = 3, runs: int = 10, seed: int = SEED):
        super().__init__()
        self.k, self.runs, self.seed = k, runs, seed

    def _fit(self, df: DataFrame) -> KMeansModel:
        points = df.select(FEATURES).persist()
        try:
            fitted = [
                KMeans(k=self.k, seed=self.seed + i, featuresCol=FEATURES, predictionCol=PREDICTION).fit(points)
                for i in range(self.runs)
            ]
        finally:
            points.unpersist()
        return min(fitted, key=lambda m: m.summary.trainingCost)


def boosted_trees(
    n_estimators: int = 100, max_depth: int = 6, learning_rate: float = 0.3,
    subsample: float = 1.0, feature_share: float | None = None, min_child: float = 1.0, ridge: float = 1.0,
) -> BoostedTrees:
    """Gradient-boosted trees for all classes together, softmax loss."""
    growth = Growth(n_estimators, max_depth, learning_rate, subsample, feature_share or 1.0, ridge, 0.0, min_child, SEED)
    return BoostedTrees(growth, len(CLASSES), featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION)


def random_forest(n_trees: int = 100, max_depth: int = 10) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth, seed=SEED, featuresCol=FEATURES, labelCol=LABEL)


class MultinomialLogistic(Estimator):
    """Logistic regression that minimises ``strength`` times the sum of losses plus half the squared weights, so the penalty
    on the mean loss is 1 / (strength * rows)."""

    def __init__(self, max_iter: int = 1000, strength: float = 1.0):
        super().__init__()
        self.max_iter, self.strength = max_iter, strength

    def _fit(self, df: DataFrame):
        rows = max(df.count(), 1)
        return LogisticRegression(
            family="multinomial", maxIter=self.max_iter, regParam=1.0 / (self.strength * rows), standardization=False,
            featuresCol=FEATURES, labelCol=LABEL,
        ).fit(df)


def multinomial_logistic(max_iter: int = 1000, strength: float = 1.0) -> MultinomialLogistic:
    return MultinomialLogistic(max_iter, strength)


def kernel_svm(landmarks: int = 256) -> KernelMachine:
    return KernelMachine(len(CLASSES), landmarks=landmarks, featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION)


def dense_network(n_features: int, hidden: tuple[int, ...] = (64, 32), epochs: int = 50) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        layers=[n_features, *hidden, len(CLASSES)], maxIter=epochs, blockSize=128, seed=SEED,
        featuresCol=FEATURES, labelCol=LABEL,
    )


def bottleneck_network(n_features: int, width: int = 32, epochs: int = 50) -> Pipeline:
    """Linear encoder to ``width`` numbers, then a 128-64-32 network."""
    width = min(width, n_features)
    network = dense_network(width, (128, 64, 32), epochs).setFeaturesCol("encoded")
    return Pipeline(stages=[PCA(k=width, inputCol=FEATURES, outputCol="encoded"), network])


# Model names and sizes below are fixed values.
# --- catalogues -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Entry:
    make: Callable[[], object]
    description: str


def baseline_models() -> dict[str, Entry]:
    return {
        "xgboost_baseline": Entry(lambda: boosted_trees(), "boosted trees, default size"),
        "xgboost_tuned": Entry(
            lambda: boosted_trees(300, 3, 0.1, subsample=0.5, feature_share=0.5), "boosted trees, many shallow trees"
        ),
        "rf_baseline": Entry(lambda: random_forest(100, 10), "random forest of depth 10"),
        "logistic": Entry(lambda: multinomial_logistic(), "multinomial logistic regression"),
    }


def advanced_models() -> dict[str, Entry]:
    return {
        "random_forest": Entry(lambda: random_forest(100, 30), "random forest, as deep as allowed"),
        "gradient_boosting": Entry(lambda: boosted_trees(100, 3, 0.1, min_child=0.0, ridge=0.0), "gradient boosting"),
        "svm": Entry(lambda: kernel_svm(), "support vector machine with RBF kernel and probabilities"),
        "xgboost_tuned": Entry(lambda: boosted_trees(200, 5, 0.1), "boosted trees, tuned"),
    }


def unsupervised_models() -> dict[str, Entry]:
    """``dbscan`` makes a function of points (id, v) that gives (id, core, cluster); the others make estimators."""
    return {
        "kmeans": Entry(lambda: BestKMeans(3, 10), "k-means, best of ten starts"),
        "dbscan": Entry(lambda: lambda points: dbscan_vectors(points, 0.5, 5), "density clustering of all columns"),
        "agg_clustering": Entry(lambda: WardClustering(3, featuresCol=FEATURES, predictionCol=PREDICTION), "Ward clustering"),
    }


def signature_model() -> BoostedTrees:
    """The model used on path signatures."""
    return boosted_trees(300, 4, 0.1, subsample=0.8, feature_share=0.8)


def all_models() -> dict[str, Entry]:
    """Classifiers by name; a baseline entry wins over an advanced one of the same name."""
    return advanced_models() | baseline_models()
