"""Iterative imputation: every column is regressed on all others, round after round.

A row's imputed state after t rounds depends only on the raw row and on the t fitted
coefficient matrices, so nothing is stored between rounds: each round scans the raw panel
once, replays the earlier rounds in memory, and returns Gram matrices. Their size depends on
the number of columns only; the regressions are solved from them on the driver.
All columns are updated together in a round (not one after another).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.schema import KEY, replace_columns, return_columns


def impute_iterative(
    df: DataFrame, columns: Sequence[str] | None = None, rounds: int = 10, tolerance: float = 1e-3
) -> DataFrame:
    """Mean start, then up to ``rounds`` rounds of Bayesian ridge regressions."""
    columns = return_columns(df) if columns is None else list(columns)
    packed = df.select(KEY, S.pack(columns).alias("r"))
    row = packed.selectExpr(*[f"avg(get(r, {i}))" for i in range(len(columns))]).first()
    start = np.array([np.nan if v is None else v for v in row], dtype=float)
    start = np.where(np.isnan(start), 0.0, start)
    models: list[np.ndarray] = []
    for _ in range(rounds):
        grams = _grams(packed, start, models, len(columns))
        if not grams:
            break
        fitted = models[-1].copy() if models else np.zeros((len(columns), len(columns) + 1))
        for f, gram in grams.items():
            fitted[f] = _bayesian_ridge(gram, f)
        settled = bool(models) and np.max(np.abs(fitted - models[-1])) < tolerance
        models.append(fitted)
        if settled:
            break

    width = len(columns)

    @F.pandas_udf("array<double>")
    def fill(r: pd.Series) -> pd.Series:
        return pd.Series(list(_replay(_matrix(r, width), start, models)), index=r.index)

    observed = {i for i, v in enumerate(row) if v is not None}
    fresh = {c: v for i, (c, v) in enumerate(S.unpack("__filled", columns).items()) if i in observed}
    return replace_columns(df.withColumn("__filled", fill(S.pack(columns))), fresh, ["__filled"])


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    return np.array(rows.tolist(), dtype=float).reshape(len(rows), width)


def _replay(raw: np.ndarray, start: np.ndarray, models: Sequence[np.ndarray]) -> np.ndarray:
    gaps = np.isnan(raw)
    state = np.where(gaps, start, raw)
    for model in models:
        state = np.where(gaps, state @ model[:, 1:].T + model[:, 0], raw)
    return state


def _grams(packed: DataFrame, start: np.ndarray, models: list[np.ndarray], width: int) -> dict[int, np.ndarray]:
    """Per column with gaps: sum of z z' over the rows that have it, z = (1, imputed row)."""
    names = [f"g{j}" for j in range(width + 1)]
    schema = "feature int, line int, gaps long, " + ", ".join(f"{n} double" for n in names)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((width, width + 1, width + 1))
        gaps = np.zeros(width, dtype=np.int64)
        for batch in batches:
            raw = _matrix(batch["r"], width)
            state = _replay(raw, start, models)
            z = np.hstack([np.ones((len(raw), 1)), state])
            everything = z.T @ z
            absent = np.isnan(raw)
            gaps += absent.sum(axis=0)
            for f in range(width):
                # Rows without the column are the fewer ones: take them off the full product.
                off = z[absent[:, f]]
                sums[f] += everything - off.T @ off
        index = np.indices((width, width + 1)).reshape(2, -1)
        out = pd.DataFrame(sums.reshape(-1, width + 1), columns=names)
        out.insert(0, "gaps", gaps[index[0]])
        out.insert(0, "line", index[1].astype(np.int32))
        out.insert(0, "feature", index[0].astype(np.int32))
        yield out

    total = (
        packed.select("r")
        .mapInPandas(partial, schema)
        .groupBy("feature", "line")
        .agg(F.sum("gaps").alias("gaps"), *[F.sum(n).alias(n) for n in names])
        .where(F.col("gaps") > 0)
        .toPandas()
        .sort_values(["feature", "line"])
    )
    return {int(f): part[names].to_numpy() for f, part in total.groupby("feature") if part[names[0]].iloc[0] > 1}


def _bayesian_ridge(gram: np.ndarray, target: int, steps: int = 300) -> np.ndarray:
    """Evidence-maximising ridge of one column on the others, from the Gram matrix alone.

    Returns intercept and weights, with weight 0 for the column itself.
    """
    width = gram.shape[0] - 1
    n = gram[0, 0]
    means = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(means, means)
    others = np.array([j for j in range(width) if j != target])
    xx, xy, yy = centred[np.ix_(others, others)], centred[others, target], max(centred[target, target], 0.0)
    values, vectors = np.linalg.eigh(xx)
    values = np.maximum(values, 0.0)
    rotated = vectors.T @ xy
    variance = yy / n
    noise, prior = (1.0 / variance if variance > 0 else 1.0), 1.0
    previous = None
    for _ in range(steps):
        inner = rotated / (values + prior / noise)
        residual = max(yy - 2.0 * inner @ rotated + inner @ (values * inner), 1e-12)
        gamma = np.sum(noise * values / (prior + noise * values))
        prior = (gamma + 2e-6) / (inner @ inner + 2e-6)
        noise = (n - gamma + 2e-6) / (residual + 2e-6)
        if previous is not None and np.sum(np.abs(inner - previous)) < 1e-3:
            break
        previous = inner
    weights = np.zeros(width + 1)
    coefficients = vectors @ (rotated / (values + prior / noise))
    weights[1 + others] = coefficients
    weights[0] = means[target] - means[others] @ coefficients
    return weights
