"""Kernel machine with probabilities: landmark features, a linear margin a pair of classes, sigmoids, pairwise coupling.

The RBF kernel is taken to a bounded number of landmark rows (those of least hash) and whitened, k(x, L) K(L, L)^(-1/2), so that
inner products of the features are the Nystroem approximation of the kernel, exact between landmarks. Each pair of classes gets a
margin with squared hinge loss on its rows. A sigmoid over margins of held-out folds turns a margin into a chance; folds depend on a hash
of the row, so copies of a row are never on both sides. The chances of all pairs are coupled into one distribution (Wu, Lin and Weng,
2004), whose largest class is predicted.

Margins and sigmoids are found by Newton steps. A step is one scan that serves all pairs and folds: tasks add up what the step needs, a
matrix as wide as the landmarks for each pair and fold, and the driver solves it. Few steps are needed, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.scratch import stored

LANDMARKS = 256
FOLDS = 3
STEPS = 25  # Newton steps at most
SETTLED = 1e-7  # of the loss
SMALLEST = 1e-10  # eigenvalues of the landmarks' kernel below that share of the largest are left out


def kernel(x: np.ndarray, landmarks: np.ndarray, gamma: float) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (landmarks * landmarks).sum(1)[None, :] - 2 * (x @ landmarks.T)
    return np.exp(-gamma * np.maximum(d, 0))


def whitening(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
    kept = values > SMALLEST * values.max()
    return vectors[:, kept] / np.sqrt(values[kept])


def coupled(chance: np.ndarray) -> np.ndarray:
    """(row, class) distributions from (row, i, j) chances of i against j: the minimum of sum (r_ji p_i - r_ij p_j)^2."""
    rows, k, _ = chance.shape
    if k == 1:
        return np.ones((rows, 1))
    system = np.zeros((rows, k + 1, k + 1))
    against = np.swapaxes(chance, 1, 2)
    system[:, :k, :k] = -against * chance
    for i in range(k):
        others = [j for j in range(k) if j != i]
        system[:, i, i] = (against[:, i, others] ** 2).sum(1)
    system[:, :k, k] = system[:, k, :k] = 1
    right = np.zeros((rows, k + 1, 1))
    right[:, k] = 1
    p = np.maximum(np.linalg.solve(system, right)[:, :k, 0], 0)
    return p / p.sum(1, keepdims=True)


class KernelMachineModel(Model):
    """``pairs``: (i, j) -> (weights, intercept, slope, shift) for i against j over the labels in ``present``."""

    def __init__(self, landmarks, gamma, white, present: list[int], pairs: dict, classes: int, names: tuple[str, str, str]):
        super().__init__()
        self.landmarks, self.gamma, self.white, self.present, self.pairs, self.numClasses = landmarks, gamma, white, present, pairs, classes
        self.featuresCol, self.predictionCol, self.probabilityCol = names

    def chances(self, x: np.ndarray) -> np.ndarray:
        features, k = kernel(x, self.landmarks, self.gamma) @ self.white, len(self.present)
        chance = np.full((len(x), k, k), 0.5)
        for (i, j), (weights, intercept, slope, shift) in self.pairs.items():
            a, b = self.present.index(i), self.present.index(j)
            own = 1 / (1 + np.exp(-np.clip(slope * (features @ weights + intercept) + shift, -30, 30)))
            chance[:, a, b], chance[:, b, a] = own, 1 - own
        out = np.zeros((len(x), self.numClasses))
        out[:, self.present] = coupled(np.clip(chance, 1e-7, 1 - 1e-7))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        chances = self.chances

        @F.pandas_udf("array<double>")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                parts = [chances(np.stack(batch.to_numpy()[at:at + 2048])) for at in range(0, len(batch), 2048)]
                yield pd.Series([row for part in parts for row in part], dtype=object)

        scored = df.withColumn(self.probabilityCol, scores(vector_to_array(F.col(self.featuresCol))))
        top = F.array_position(self.probabilityCol, F.array_max(self.probabilityCol)) - 1
        return scored.withColumn(self.predictionCol, top.cast("double")).withColumn(self.probabilityCol, array_to_vector(self.probabilityCol))

    def __reduce__(self):
        names = (self.featuresCol, self.predictionCol, self.probabilityCol)
        return KernelMachineModel, (self.landmarks, self.gamma, self.white, self.present, self.pairs, self.numClasses, names)


class KernelMachine(Estimator):
    """``cost`` weighs the losses against half the squared weights; ``gamma`` by default 1 over (columns times variance of all values)."""

    def __init__(self, classes: int = 3, cost: float = 1.0, gamma: float | None = None, landmarks: int = LANDMARKS, featuresCol: str = "features",
                 labelCol: str = "label", predictionCol: str = "prediction", probabilityCol: str = "probability"):
        super().__init__()
        self.classes, self.cost, self.gamma, self.landmarks = classes, cost, gamma, landmarks
        self.featuresCol, self.labelCol, self.predictionCol, self.probabilityCol = featuresCol, labelCol, predictionCol, probabilityCol

    def _fit(self, df: DataFrame) -> KernelMachineModel:
        rows = stored(df.select(vector_to_array(F.col(self.featuresCol)).alias("x"), F.col(self.labelCol).cast("int").alias("label")).where(
            F.col("label").isNotNull()), "kernel-rows")
        value = rows.select(F.explode("x").alias("v")).agg(F.var_pop("v").alias("v")).first()["v"]
        chosen = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(self.landmarks).collect()
        if not chosen:
            raise ValueError("no rows with a label")
        marks = np.array([r["x"] for r in chosen])
        gamma = self.gamma or 1.0 / (marks.shape[1] * (value or 1.0))
        white = whitening(marks, gamma)

        @F.pandas_udf("array<double>")
        def lifted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(list(kernel(np.stack(batch.to_numpy()), marks, gamma) @ white) if len(batch) else [], dtype=object)

        fold = F.pmod(F.xxhash64(F.lit(3), "x"), F.lit(FOLDS))
        data = stored(rows.select("label", fold.cast("int").alias("fold"), lifted("x").alias("z")), "kernel-features")
        present = sorted(r["label"] for r in data.select("label").distinct().collect())
        pairs = list(combinations(present, 2))
        problems = [(i, j, f) for i, j in pairs for f in (-1, *range(FOLDS))]
        margins = _newton(data, problems, white.shape[1] + 1, _hinge(self.cost), ridge=1.0)
        held = {(i, j): [margins[i, j, f] for f in range(FOLDS)] for i, j in pairs}
        curves = _newton(data, pairs, 2, _sigmoid(held), ridge=0.0)
        known = {(i, j): (margins[i, j, -1][:-1], margins[i, j, -1][-1], *curves[i, j]) for i, j in pairs}
        return KernelMachineModel(marks, gamma, white, present, known, self.classes, (self.featuresCol, self.predictionCol, self.probabilityCol))


def _newton(data: DataFrame, problems: list[tuple], width: int, terms, ridge: float) -> dict[tuple, np.ndarray]:
    """Minimises ridge / 2 times the squared weights (the last one free) plus the losses that ``terms`` gives, for all problems at once.

    ``terms(problem, weights, label, fold, z)`` returns (second derivatives, gradient, loss) summed over rows.
    """
    now = {p: np.zeros(width) for p in problems}
    best = {p: (np.inf, np.zeros(width)) for p in problems}
    going = set(problems)
    penalty = np.append(np.full(width - 1, ridge), 0.0)
    for _ in range(STEPS):
        if not going:
            break
        weights = {p: now[p] for p in problems if p in going}

        def add(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            total = {p: np.zeros((width + 1, width + 1)) for p in weights}
            for batch in batches:
                if not len(batch):
                    continue
                z = batch.column("z").flatten().to_numpy().reshape(len(batch), -1)
                label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
                for p, w in weights.items():
                    second, gradient, loss = terms(p, w, label, fold, z)
                    total[p][:width, :width] += second
                    total[p][width, :width] += gradient
                    total[p][width, width] += loss
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["p", "sums"])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for p, sums in zip(batch.column("p").to_pylist(), batch.column("sums").to_pylist()):
                    total[p] = total.get(p, 0) + np.frombuffer(sums)
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["p", "sums"])

        added = data.mapInArrow(add, "p int, sums binary").repartition("p").mapInArrow(merge, "p int, sums binary").collect()  # a row a problem
        names = list(weights)
        for r in added:
            p, sums = names[r["p"]], np.frombuffer(r["sums"]).reshape(width + 1, width + 1)
            w = now[p]
            loss = sums[width, width] + (penalty * w * w).sum() / 2
            before, kept = best[p]
            if loss > before:  # too far: half the way back
                now[p] = (w + kept) / 2
                if np.abs(w - kept).max() < 1e-9:
                    now[p] = kept
                    going.discard(p)
                continue
            best[p] = loss, w
            if np.isfinite(before) and before - loss <= SETTLED * max(abs(before), 1e-12):
                going.discard(p)
                continue
            second = sums[:width, :width] + np.diag(penalty) + 1e-9 * np.eye(width)
            now[p] = w - np.linalg.solve(second, sums[width, :width] + penalty * w)
    return {p: w for p, (_, w) in best.items()}


def _hinge(cost: float):
    """Squared hinge of class i against j on the rows outside a fold (-1: on all)."""
    def terms(problem, w, label, fold, z):
        i, j, without = problem
        used = ((label == i) | (label == j)) & (fold != without)
        x = np.hstack([z[used], np.ones((int(used.sum()), 1))])
        y = np.where(label[used] == i, 1.0, -1.0)
        short = 1 - y * (x @ w)
        active = short > 0
        x, y, short = x[active], y[active], short[active]
        return 2 * cost * x.T @ x, -2 * cost * x.T @ (y * short), cost * float((short**2).sum())

    return terms


def _sigmoid(held: dict):
    """Logistic loss of (slope, shift) over the margins of the rows of held-out folds."""
    def terms(problem, w, label, fold, z):
        i, j = problem
        used = (label == i) | (label == j)
        if not used.any():
            return np.zeros((2, 2)), np.zeros(2), 0.0
        weights = np.stack(held[problem])[fold[used]]
        margin = (z[used] * weights[:, :-1]).sum(1) + weights[:, -1]
        x = np.stack([margin, np.ones(len(margin))], 1)
        y = (label[used] == i).astype(float)
        s = np.clip(x @ w, -500, 500)
        p = 1 / (1 + np.exp(-s))
        loss = np.logaddexp(0, s) - y * s
        return (x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y), float(loss.sum())

    return terms
