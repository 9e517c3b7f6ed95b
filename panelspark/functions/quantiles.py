"""Exact column quantiles that never gather a column in one task.

`percentile` would keep every distinct value of a column in one aggregation buffer. Quantiles
are found by counting instead: split the value range of each column into equal buckets, count
them (partial aggregation keeps this small), keep the bucket that holds the wanted rank, and
repeat inside it. A few scans give the exact order statistics, however many rows or repeated
values there are. NaN counts as missing; infinities sort outside all other values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from panelspark.schema import literal, quoted

BUCKETS = 2048
LARGEST = sys.float_info.max


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles per column, missing values skipped.

    Returns plain numbers (columns x probabilities of them), ready to be used as literals.
    """
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    if not columns:
        return {}
    # Infinities become the largest finite numbers and are put back at the end.
    source = df.selectExpr(*[
        f"CASE WHEN {quoted(c)} IS NOT NULL AND NOT isnan(double({quoted(c)})) THEN greatest(least(double({quoted(c)}), {LARGEST!r}D), -{LARGEST!r}D) END AS c{i}"
        for i, c in enumerate(columns)
    ])
    names = [f"c{i}" for i in range(len(columns))]
    bounds = source.selectExpr(
        *[f"{f}({n}) AS {k}_{n}" for n in names for k, f in (("n", "count"), ("lo", "min"), ("hi", "max"))]
    ).first()
    return _by_counting(source, columns, probabilities, bounds)


def _by_counting(
    source: DataFrame, columns: list[str], probabilities: list[float], bounds: Row
) -> dict[str, list[float | None]]:
    names = [f"c{i}" for i in range(len(columns))]
    counts = [bounds[f"n_{n}"] for n in names]
    # A target is one order statistic: (column, 0-based rank). Its bracket shrinks every pass.
    found: dict[tuple[int, int], float] = {}
    open_targets: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i, n in enumerate(names):
        for p in probabilities:
            if counts[i]:
                at = p * (counts[i] - 1)
                for rank in (math.floor(at), math.ceil(at)):
                    open_targets[(i, rank)] = (bounds[f"lo_{n}"], bounds[f"hi_{n}"], 0)
    while open_targets:
        for key, (lo, hi, _) in list(open_targets.items()):
            if lo == hi:
                found[key] = lo
                del open_targets[key]
        if not open_targets:
            break
        brackets = sorted({(i, lo, hi) for (i, _), (lo, hi, _) in open_targets.items()})
        histogram = _histogram(source, names, brackets)
        for key, (lo, hi, skipped) in list(open_targets.items()):
            for b_lo, b_hi, count in histogram[(key[0], lo, hi)]:
                if key[1] < skipped + count:
                    if (b_lo, b_hi) == (lo, hi):
                        raise RuntimeError(f"values of {columns[key[0]]} between {lo} and {hi} can't be told apart")
                    open_targets[key] = (b_lo, b_hi, skipped)
                    break
                skipped += count
    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        values: list[float | None] = []
        for p in probabilities:
            if not counts[i]:
                values.append(None)
                continue
            at = p * (counts[i] - 1)
            low, high = (_outer(found[(i, r)]) for r in (math.floor(at), math.ceil(at)))
            values.append(low if low == high or at == math.floor(at) else low + (high - low) * (at - math.floor(at)))
        result[c] = values
    return result


def _outer(x: float) -> float:
    return math.copysign(math.inf, x) if abs(x) == LARGEST else x


def _histogram(source: DataFrame, names: list[str], brackets: list[tuple[int, float, float]]):
    """Buckets (min, max, count) in value order for every (column, lo, hi) bracket."""
    by_column: list[list[str]] = [[] for _ in names]
    for b, (i, lo, hi) in enumerate(brackets):
        by_column[i].append(f"named_struct('b', {b}, 'lo', {literal(float(lo))}, 'hi', {literal(float(hi))})")
    wanted = [i for i, entries in enumerate(by_column) if entries]
    values = source.selectExpr(f"posexplode(array({', '.join(names[i] for i in wanted)})) AS (pos, x)").where("x IS NOT NULL")
    if len(brackets) == len(wanted):
        # One bracket per column: a lookup is enough.
        table = f"array({', '.join(by_column[i][0] for i in wanted)})"
        placed = values.selectExpr("x", f"get({table}, pos) AS e")
    else:
        table = f"array({', '.join('array(' + ', '.join(by_column[i]) + ')' for i in wanted)})"
        placed = values.selectExpr("x", f"explode(get({table}, pos)) AS e")
    # Every step is monotone in x even after rounding, so buckets never overlap.
    bucket = f"int(least(floor((x / 2 - e.lo / 2) / (e.hi / 2 - e.lo / 2) * {BUCKETS}), {BUCKETS - 1}))"
    rows = (
        placed.where("x BETWEEN e.lo AND e.hi")
        .selectExpr("e.b AS b", f"{bucket} AS k", "x")
        .groupBy("b", "k")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    result: dict[tuple, list] = {key: [] for key in brackets}
    for row in sorted(rows, key=lambda r: (r["b"], r["k"])):
        result[brackets[row["b"]]].append((row["lo"], row["hi"], row["n"]))
    return result
