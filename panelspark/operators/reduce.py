"""Principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.operators.scale import LinearScaler, fit_scaler

# Shares of variance that are reported.
THRESHOLDS = (0.7, 0.8, 0.9, 0.95, 0.99)


@dataclass(frozen=True)
class Components:
    """Fitted components of standardised, zero-filled columns."""

    columns: list[str]
    scaler: LinearScaler
    model: PCAModel
    signs: np.ndarray

    def variance(self) -> DataFrame:
        """(component, ratio, cumulative)."""
        ratios = [float(v) for v in self.model.explainedVariance.toArray()]
        rows = list(enumerate(ratios, start=1))
        table = _session().createDataFrame(rows, "component int, ratio double")
        # One row per component.
        return table.withColumn("cumulative", running_total("ratio", "component"))

    def loadings(self, n_components: int = 10, top: int = 5) -> DataFrame:
        """(component, rank, feature, loading): the strongest columns of each component."""
        matrix = self.model.pc.toArray() * self.signs
        rows = []
        for j in range(min(n_components, matrix.shape[1])):
            order = sorted(range(len(self.columns)), key=lambda i: (-abs(matrix[i, j]), self.columns[i]))[:top]
            rows += [(j + 1, rank, self.columns[i], float(matrix[i, j])) for rank, i in enumerate(order, start=1)]
        return _session().createDataFrame(rows, "component int, rank int, feature string, loading double")

    def transform(self, df: DataFrame, name: str = "components") -> DataFrame:
        """Add the scores of each row as an array."""
        prepared = _vectors(self.scaler.transform(df.na.fill(0.0, self.columns)), self.columns)
        scored = self.model.transform(prepared)
        raw = vector_to_array("__scores")
        signs = F.array(*[F.lit(float(s)) for s in self.signs])
        scores = scored.withColumn(name, F.zip_with(raw, signs, lambda x, s: x * s))
        kept = scores.drop("__vector", "__scores", *self.columns)
        return kept


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.active()


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="__vector").transform(df)


def fit_components(df: DataFrame, columns: Sequence[str], k: int | None = None) -> Components:
    """PCA on the standardised columns of all rows. Each component is signed so that its largest
    loading is positive."""
    columns = list(columns)
    filled = df.select(*columns).na.fill(0.0)
    scaler = fit_scaler("standard", filled, columns)
    vectors = _vectors(scaler.transform(filled), columns)
    model = PCA(k=min(k or len(columns), len(columns)), inputCol="__vector", outputCol="__scores").fit(vectors)
    matrix = model.pc.toArray()
    peak = np.abs(matrix).argmax(axis=0)
    signs = np.where(matrix[peak, np.arange(matrix.shape[1])] < 0, -1.0, 1.0)
    return Components(columns, scaler, model, signs)


def running_total(value: str, order: str):
    """Running sum over a small table such as one row per component."""
    return F.sum(value).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, 0))


def components_needed(variance: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """(threshold, components): first component whose cumulative share reaches the threshold, NULL if none does."""
    wanted = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    reached = F.min(F.when(F.col("cumulative") >= F.col("threshold"), F.col("component")))
    return variance.select("component", "cumulative", wanted).groupBy("threshold").agg(reached.alias("components"))
