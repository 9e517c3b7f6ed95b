"""Feature-group profiles and the table of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.correlate import correlation_matrix, extremes, target_correlations
from panelspark.operators.features import with_plain_row
from panelspark.operators.profile import at_position, column_stats, long_values
from panelspark.operators.reduce import components_needed
from panelspark.operators.results import importance_share
from panelspark.operators.scale import fit_scaler
from panelspark.schema import TARGET, feature_groups, quoted, return_columns


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def group_profile(df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None, target: str = TARGET) -> dict[str, DataFrame]:
    """Per feature group: spread of column means and deviations, gaps, target and inner correlations.

    Groups without a column are left out.
    """
    groups = {g: list(c) for g, c in (groups or feature_groups(df)).items() if c}
    columns = sorted({c for members in groups.values() for c in members})
    stats = long_values(df, columns).groupBy("pos").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.count_if(F.col("value").isNull()).alias("missing"),
    ).select(at_position(columns).alias("column"), "mean", "std", "missing")
    member = [(g, c) for g, cols in groups.items() for c in cols]
    names = df.sparkSession.createDataFrame(member, "group string, column string")
    each = names.join(stats, "column")

    def spread(c: str):
        # A group has as many rows as it has columns.
        return [
            F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"),
            F.percentile(c, F.lit(0.5)).alias(f"{c}_median"), F.max(c).alias(f"{c}_max"),
        ]

    profile = each.groupBy("group").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("missing").alias("missing"), *spread("mean"), *spread("std")
    )
    out = {"stats": profile}
    if target in df.columns:
        corr = names.join(target_correlations(df, columns, target), "column")
        out["target"] = corr.groupBy("group").agg(F.avg(F.abs("corr")).alias("mean_abs_corr"))
        out["target_extremes"] = _stack(
            [extremes(corr.where(F.col("group") == g), "corr", 3).select(F.lit(g).alias("group"), "*") for g in groups]
        )
    inner = [
        correlation_matrix(df, cols).select(F.lit(g).alias("group"), "*") for g, cols in groups.items() if len(cols) > 1
    ]
    if inner:
        out["inner"] = _stack(inner)
    return out


NORMALISATIONS = ("original", "standard", "robust", "quantile", "row")


def normalised_columns(df: DataFrame, columns: Sequence[str], methods: Sequence[str] = NORMALISATIONS) -> DataFrame:
    """Chosen columns of the zero-filled panel under each normalisation, named ``<method>:<column>``."""
    returns = return_columns(df)
    filled = with_plain_row(df.na.fill(0.0, returns), returns, "__row").select(*columns, "__row")
    out = filled
    for method in methods:
        name = {c: f"{method}:{c}" for c in columns}
        if method == "original":
            copies = {n: quoted(c) for c, n in name.items()}
        elif method == "row":
            copies = {n: f"get(__row, {returns.index(c)})" for c, n in name.items()}
        else:
            copies = {n: quoted(c) for c, n in name.items()}
        out = out.selectExpr("*", *[f"{v} AS {quoted(n)}" for n, v in copies.items()])
        if method in ("standard", "robust", "quantile"):
            out = fit_scaler(method, filled, columns).renamed(name).transform(out)
    return out.drop(*columns, "__row")


def compare_normalisations(
    df: DataFrame, columns: Sequence[str], methods: Sequence[str] = NORMALISATIONS
) -> DataFrame:
    """(method, column, mean, median, std, skewness, kurtosis), all normalisations in one pass after fitting."""
    wide = normalised_columns(df, columns, methods)
    parts = F.split("column", ":")
    return column_stats(wide, wide.columns).select(
        parts[0].alias("method"), parts[1].alias("column"), "mean", "median", "std", "skewness", "kurtosis"
    )


def correlations_by_normalisation(
    df: DataFrame, columns: Sequence[str], methods: Sequence[str] = NORMALISATIONS
) -> DataFrame:
    """(method, var1, var2, corr) of chosen columns under each normalisation."""
    wide = normalised_columns(df, columns, methods)
    return _stack([
        correlation_matrix(wide.selectExpr(*[f"{quoted(f'{m}:{c}')} AS {quoted(c)}" for c in columns]), columns).select(
            F.lit(m).alias("method"), "*"
        )
        for m in methods
    ])


def pivot_normalisations(stats: DataFrame, methods: Sequence[str]) -> DataFrame:
    """(column, <method>_<statistic> ...), means of repeated entries."""
    values = ["mean", "std", "skewness", "kurtosis"]
    return stats.groupBy("column").pivot("method", list(methods)).agg(*[F.avg(v).alias(v) for v in values])


def findings(
    variance: DataFrame | None,
    loadings: DataFrame | None,
    strong: DataFrame | None,
    target: DataFrame | None,
    importance: DataFrame | None,
    selected: Sequence[str] = (),
) -> DataFrame:
    """(section, key, value) rows that sum up an analysis, numbers with four digits behind the point."""
    def rows(df: DataFrame, section: str, key, value) -> DataFrame:
        return df.select(F.lit(section).alias("section"), key.cast("string").alias("key"), value.cast("string").alias("value"))

    parts = []
    if variance is not None:
        needed = components_needed(variance, (0.7, 0.8, 0.9, 0.95))
        parts.append(rows(needed, "components", F.col("threshold"), F.col("components")))
    if loadings is not None:
        first = loadings.where((F.col("component") == 1) & (F.col("rank") <= 3))
        parts.append(rows(first, "first component", F.col("rank"), F.col("feature")))
    if strong is not None:
        parts.append(rows(strong.agg(F.count(F.lit(1)).alias("n")), "strong pairs", F.lit("count"), F.col("n")))
        top = strong.orderBy(F.abs("corr").desc(), "var1", "var2").limit(3)
        parts.append(rows(top, "strong pairs", F.concat_ws(" / ", "var1", "var2"), F.format_string("%.4f", "corr")))
    if target is not None:
        parts.append(rows(extremes(target, "corr", 3), "target", F.concat_ws(" ", "side", "column"), F.format_string("%.4f", "corr")))
    if importance is not None:
        top = importance.orderBy(F.col("importance").desc(), "feature").limit(5)
        parts.append(rows(top, "importance", F.col("feature"), F.format_string("%.4f", "importance")))
        parts.append(rows(importance_share(importance), "importance", F.lit("top 10 share"), F.format_string("%.4f", "importance")))
    if selected:
        counts = [
            ("selected", str(len(selected))),
            ("returns", str(sum(c[:1] == "r" and c[1:].isdigit() for c in selected))),
            ("derived", str(sum(c.startswith("r_") for c in selected))),
        ]
        from pyspark.sql import SparkSession

        table = SparkSession.active().createDataFrame(counts, "key string, value string")
        parts.append(rows(table, "selection", F.col("key"), F.col("value")))
    return _stack(parts)
