"""Correlations between columns and with the target."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.sketch import nan_to_null
from panelspark.operators.profile import at_position
from panelspark.schema import TARGET, literal, quoted, return_columns


def correlation_matrix(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """Long matrix (var1, var2, corr), all ordered pairs.

    With ``fill`` the rows are complete and the whole matrix comes from one pass of vector
    products. Without it missing values are skipped pair by pair, in one pass too.
    """
    columns = list(columns)
    if fill is not None:
        filled = df.selectExpr(*[f"coalesce(double({quoted(c)}), {literal(float(fill))}) AS {quoted(c)}" for c in columns])
        vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(filled).select("v")
        values = Correlation.corr(vectors, "v").first()[0].toArray()
        rows = [
            (a, b, None if values[i, j] != values[i, j] else float(values[i, j]))
            for i, a in enumerate(columns)
            for j, b in enumerate(columns)
        ]
        return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, corr double")
    return _pairwise(df, columns)


def _pairwise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values skipped pair by pair: every task sums count, x, xx and xy over the rows where both of a pair are present,
    as products of its values with its mask, and hands on one row a pair. Values are shifted by their column's minimum first,
    so constant columns have a spread of exactly zero."""
    d = len(columns)
    low = df.selectExpr(*[f"min(double({quoted(c)}))" for c in columns]).first()
    shift = np.array([v if v is not None and np.isfinite(v) else 0.0 for v in low])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, d, d))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - shift
            seen = ~np.isnan(x)
            x[~seen] = 0.0
            mask = seen.astype(float)
            total += [mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x]
        i, j = np.divmod(np.arange(d * d), d)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, *total.reshape(4, -1))], names=["i", "j", "n", "sx", "sxx", "sxy"])

    numbers = df.selectExpr(*[f"double({quoted(c)}) AS c{i}" for i, c in enumerate(columns)])
    parts = numbers.mapInArrow(sums, "i long, j long, n double, sx double, sxx double, sxy double")
    each = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")])
    other = each.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    both = each.join(other, ["i", "j"]).withColumns({
        "vx": F.expr("sxx - sx * sx / nullif(n, 0)"), "vy": F.expr("syy - sy * sy / nullif(n, 0)"), "cov": F.expr("sxy - sx * sy / nullif(n, 0)")})
    # What rounding leaves of a spread of zero is far below the sums it comes from.
    spread = F.expr("n > 1 AND vx > 1e-12 * sxx AND vy > 1e-12 * syy")
    corr = F.when(spread, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.expr("cov / sqrt(vx) / sqrt(vy)"))))
    name = F.array(*[F.lit(c) for c in columns])
    return both.select(F.get(name, F.col("i")).alias("var1"), F.get(name, F.col("j")).alias("var2"), corr.alias("corr"))


def target_correlations(df: DataFrame, columns: Sequence[str], target: str = TARGET, fill: float | None = None) -> DataFrame:
    """(column, corr) of each column with the target, missing values skipped pair by pair; NULL where one of them is constant."""
    columns = list(columns)
    rest = "CAST(NULL AS DOUBLE)" if fill is None else literal(float(fill))

    def pair(c: str) -> str:
        x, y = f"coalesce(double({quoted(c)}), {rest})", f"double({quoted(target)})"
        spread = " * ".join(f"var_pop(if({b} IS NULL, NULL, {a}))" for a, b in ((x, y), (y, x)))
        return f"try_divide(covar_pop({x}, {y}), sqrt({spread}))"

    pairs = [pair(c) for c in columns]
    each = df.selectExpr(f"posexplode(array({', '.join(pairs)})) AS (pos, corr)")
    return each.select(at_position(columns).alias("column"), nan_to_null(F.col("corr")).alias("corr"))


def strong_pairs(matrix: DataFrame, order: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Each unordered pair once, abs(corr) above the threshold, strongest first."""
    place = F.create_map(*[F.lit(v) for i, c in enumerate(order) for v in (c, i)])
    return matrix.where((place[F.col("var1")] < place[F.col("var2")]) & (F.abs("corr") > threshold)).orderBy(
        F.abs("corr").desc(), "var1", "var2"
    )


def correlation_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """(var1, var2, change) between two long matrices."""
    old = before.withColumnRenamed("corr", "old")
    return after.join(old, ["var1", "var2"]).select("var1", "var2", (F.col("corr") - F.col("old")).alias("change"))


def normalisation_impact(original: DataFrame, normalised: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Change of the correlations of a few columns between two versions of a panel."""
    return correlation_change(correlation_matrix(original, columns), correlation_matrix(normalised, columns))


def extremes(ranked: DataFrame, score: str, n: int, name: str = "column") -> DataFrame:
    """(side, name, score): the n largest and n smallest, undefined scores left out."""
    known = ranked.where(F.col(score).isNotNull()).select(name, score)
    top = known.orderBy(F.col(score).desc(), name).limit(n).withColumn("side", F.lit("top"))
    bottom = known.orderBy(F.col(score).asc(), name).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def correlation_report(df: DataFrame, threshold: float = 0.8, target: str = TARGET) -> dict[str, DataFrame]:
    """Matrix, strong pairs and target correlations of the zero-filled returns, on all rows."""
    columns = return_columns(df)
    matrix = correlation_matrix(df, columns, fill=0.0)
    report = {"matrix": matrix, "strong_pairs": strong_pairs(matrix, columns, threshold)}
    if target in df.columns:
        with_target = target_correlations(df, columns, target, fill=0.0)
        report["target"] = with_target
        report["target_extremes"] = extremes(with_target, "corr", 10)
    return report
