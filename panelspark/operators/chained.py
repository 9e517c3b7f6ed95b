"""Chained imputation: one column after the other is regressed on all others, each on what those before it have just become.

Done literally, every column needs a scan of the table, since its cross-products depend on the column before. Here a scan serves a block
of columns: it sums the cross-products of the rows apart for each pattern of gaps in the block's columns, 2^BLOCK at most. Once a
column is fitted, its gaps in a pattern become a linear function of the row, so the pattern's cross-products follow by a
product of small matrices, and the next column of the block is fitted without reading a row. Rows are never stored: a scan
replays the updates so far, which are one vector of weights each.

Columns are taken by ascending number of gaps, then by place; a column without gaps or without values is not fitted. Rounds end when no cell
moves by more than ``tolerance`` times the largest present value, or after ``rounds``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.operators.iterative import _bayesian_ridge, _matrix
from panelspark.schema import replace_columns, return_columns

BLOCK = 5
Update = tuple[int, np.ndarray]  # column and its weights, the intercept first


def replay(raw: np.ndarray, start: np.ndarray, updates: Sequence[Update]) -> np.ndarray:
    """(1, imputed row) of each row after the updates."""
    gaps = np.isnan(raw)
    state = np.hstack([np.ones((len(raw), 1)), np.where(gaps, start, raw)])
    for column, weights in updates:
        at = gaps[:, column]
        state[at, 1 + column] = state[at] @ weights
    return state


def follow(sums: dict[int, np.ndarray], block: Sequence[int]) -> list[Update]:
    """Fits the columns of a block one after the other from cross-products by gap pattern; bit i: ``block[i]`` is missing."""
    sums, updates = dict(sums), []
    for i, column in enumerate(block):
        present = [g for p, g in sums.items() if not p >> i & 1]
        if not present or sum(g[0, 0] for g in present) < 2:
            continue
        weights = _bayesian_ridge(sum(present), column)
        turn = np.eye(len(weights))
        turn[1 + column] = weights
        sums = {p: turn @ g @ turn.T if p >> i & 1 else g for p, g in sums.items()}
        updates.append((column, weights))
    return updates


def _scan(packed: DataFrame, start: np.ndarray, updates: list[Update], last: int, block: Sequence[int]) -> tuple[dict[int, np.ndarray], float]:
    """Cross-products by gap pattern after the updates, and the largest move of a cell by the updates from ``last`` on."""
    width = len(start)
    names = [f"g{j}" for j in range(width + 1)]
    schema = "pattern int, line int, move double, " + ", ".join(f"{n} double" for n in names)
    block = list(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        move = 0.0
        for batch in batches:
            raw = _matrix(batch.column("r").to_pandas(), width)
            before = replay(raw, start, updates[:last])
            state = replay(raw, start, updates) if last < len(updates) else before
            move = max(move, float(np.abs(state - before).max(initial=0)))
            pattern = (np.isnan(raw[:, block]) << np.arange(len(block))).sum(1)
            for p in np.unique(pattern).tolist():
                z = state[pattern == p]
                sums[p] = sums.get(p, 0) + z.T @ z
        if sums:
            flat = np.vstack(list(sums.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(sums), width + 1), pa.int32()), pa.array(np.tile(np.arange(width + 1), len(sums)), pa.int32()),
                 pa.array(np.full(len(flat), move)), *(pa.array(flat[:, j]) for j in range(width + 1))], names=["pattern", "line", "move", *names])

    rows = packed.mapInArrow(run, schema).groupBy("pattern", "line").agg(
        F.max("move").alias("move"), *[F.sum(n).alias(n) for n in names]).orderBy("pattern", "line").toPandas()  # 2^block (width + 1) rows
    found = {int(p): part[names].to_numpy() for p, part in rows.groupby("pattern")}
    return found, float(rows["move"].max()) if len(rows) else 0.0


def fit_chain(packed: DataFrame, width: int, rounds: int = 10, tolerance: float = 1e-3, block: int = BLOCK) -> tuple[np.ndarray, list[Update]]:
    """Start values and all updates, in order; ``packed`` has one array column ``r``."""
    row = packed.selectExpr(
        *[f"avg(get(r, {i}))" for i in range(width)], *[f"sum(int(get(r, {i}) IS NULL))" for i in range(width)],
        *[f"max(abs(get(r, {i})))" for i in range(width)]).first()
    means, gaps, largest = row[:width], [g or 0 for g in row[width:2 * width]], max([m for m in row[2 * width:] if m is not None], default=0.0)
    start = np.array([0.0 if m is None else m for m in means])
    order = sorted((i for i in range(width) if gaps[i] and means[i] is not None), key=lambda i: (gaps[i], i))
    updates: list[Update] = []
    last = 0
    for round_ in range(rounds if order else 0):
        begun = len(updates)
        for at in range(0, len(order), block):
            sums, move = _scan(packed, start, updates, last if at == 0 else len(updates), order[at:at + block])
            if at == 0 and round_ and move < tolerance * largest:
                return start, updates
            updates += follow(sums, order[at:at + block])
        last = begun
    return start, updates


def impute_chained(
    df: DataFrame, columns: Sequence[str] | None = None, rounds: int = 10, tolerance: float = 1e-3, block: int = BLOCK
) -> DataFrame:
    """``df`` with the gaps of ``columns`` filled; a column without any value stays missing."""
    columns = return_columns(df) if columns is None else list(columns)
    width = len(columns)
    packed = df.select(S.pack(columns).alias("r"))
    start, updates = fit_chain(packed, width, rounds, tolerance, block)

    @F.pandas_udf("array<double>")
    def fill(r: pd.Series) -> pd.Series:
        return pd.Series(list(replay(_matrix(r, width), start, updates)[:, 1:]), index=r.index)

    row = packed.selectExpr(*[f"count(get(r, {i}))" for i in range(width)]).first()
    fresh = {c: v for i, (c, v) in enumerate(S.unpack("__filled", columns).items()) if row[i]}
    return replace_columns(df.withColumn("__filled", fill(S.pack(columns))), fresh, ["__filled"])
