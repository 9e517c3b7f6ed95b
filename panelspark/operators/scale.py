"""Column scalers: fit on one frame, apply to others."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelspark.functions.quantiles import column_quantiles
from panelspark.functions.sketch import normal_quantile
from panelspark.schema import literal, quoted, replace_columns

SCALERS = ("standard", "minmax", "robust", "quantile")


@dataclass(frozen=True)
class LinearScaler:
    """(x - centre) / scale; a column without spread is only centred."""

    centre: dict[str, float | None]
    scale: dict[str, float | None]

    def renamed(self, names: dict[str, str]) -> LinearScaler:
        """The same scaler for columns of other names."""
        return LinearScaler(*[{names[c]: v for c, v in side.items()} for side in (self.centre, self.scale)])

    def transform(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {
            c: f"({quoted(c)} - double({literal(m)})) / {literal(float(self.scale[c] or 1.0))}" for c, m in self.centre.items()
        })


@dataclass(frozen=True)
class NormalQuantileScaler:
    """Maps a column to normal scores by its empirical distribution.

    Between the fitted knots the rank is interpolated; where knots repeat, the middle of
    their rank range is used. Ranks are kept away from 0 and 1 by 1e-7.
    """

    knots: dict[str, list[float]]

    def renamed(self, names: dict[str, str]) -> NormalQuantileScaler:
        return NormalQuantileScaler({names[c]: v for c, v in self.knots.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        columns = [c for c in df.columns if c in self.knots]
        fitted = {c: np.asarray(self.knots[c], dtype=float) for c in columns}
        schema = T.StructType(
            [T.StructField(f.name, T.DoubleType()) if f.name in fitted else f for f in df.schema.fields]
        )

        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                scores = {c: _normal_scores(batch[c].to_numpy(dtype=float), fitted[c]) for c in columns}
                yield batch.assign(**scores)

        return df.mapInPandas(apply, schema)


def _normal_scores(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    ranks = np.linspace(0.0, 1.0, len(knots))
    upper = np.interp(x, knots, ranks)
    lower = 1.0 - np.interp(-x, -knots[::-1], ranks)
    p = np.clip((upper + lower) / 2.0, 1e-7, 1.0 - 1e-7)
    return np.where(np.isnan(x), np.nan, normal_quantile(p))


def fit_scaler(kind: str | None, df: DataFrame, columns: Sequence[str], n_knots: int = 1000):
    """Fitted scaler with a ``transform``; None for ``kind=None``."""
    if kind is None:
        return None
    columns = list(columns)
    if kind == "standard":
        row = df.selectExpr(*[f"{f}({quoted(c)})" for c in columns for f in ("avg", "stddev_pop")]).first()
        return LinearScaler(
            {c: row[2 * i] for i, c in enumerate(columns)}, {c: row[2 * i + 1] for i, c in enumerate(columns)}
        )
    if kind == "minmax":
        row = df.selectExpr(*[f"{f}({quoted(c)})" for c in columns for f in ("min", "max")]).first()
        span = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}
        return LinearScaler(
            {c: None if lo is None else float(lo) for c, (lo, _) in span.items()},
            {c: None if lo is None else float(hi - lo) for c, (lo, hi) in span.items()},
        )
    if kind == "robust":
        cuts = column_quantiles(df, columns, [0.25, 0.5, 0.75])
        return LinearScaler(
            {c: q[1] for c, q in cuts.items()},
            {c: None if q[0] is None else q[2] - q[0] for c, q in cuts.items()},
        )
    if kind == "quantile":
        # Knots from a mergeable sketch: fixed-size state however many rows there are.
        steps = [i / (n_knots - 1) for i in range(n_knots)]
        wanted = f"array({', '.join(map(literal, steps))})"
        row = df.selectExpr(
            *[f"percentile_approx(double({quoted(c)}), {wanted}, {10 * n_knots})" for c in columns]
        ).first()
        return NormalQuantileScaler({c: list(row[i]) for i, c in enumerate(columns) if row[i] is not None})
    raise ValueError(f"unknown scaler {kind!r}, expected one of {SCALERS}")
