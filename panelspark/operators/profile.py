"""Column statistics, null profiles, class shares, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.functions.quantiles import column_quantiles
from panelspark.functions.sketch import kurtosis, skewness
from panelspark.operators.features import add_null_profile
from panelspark.schema import TARGET, literal_array, quoted, return_columns


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(pos, value) rows for grouped statistics. The grouping key has as many values as there
    are columns, so partial aggregation removes nearly all rows before the shuffle."""
    return df.select(F.posexplode(S.pack(columns)).alias("pos", "value"))


def at_position(values: Sequence, pos: Column | str = "pos", kind: str | None = None) -> Column:
    """Literal looked up by position."""
    return F.get(literal_array(values, kind), F.col(pos) if isinstance(pos, str) else pos)


# --- nulls ------------------------------------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, null_percent) for every column, one aggregate."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"array({', '.join(f'count_if({quoted(c)} IS NULL)' for c in columns)})").alias("nulls"),
    )
    each = counts.select("n", F.posexplode("nulls").alias("pos", "null_count"))
    return each.select(
        at_position(columns).alias("column"),
        "null_count",
        (F.try_divide(F.col("null_count"), F.col("n")) * 100).alias("null_percent"),
    )


def _null_tally(df: DataFrame) -> str:
    """Missing values of a row over all columns."""
    flags = ", ".join(f"{quoted(c)} IS NULL" for c in df.columns)
    return f"size(filter(array({flags}), x -> x))"


def table_size(df: DataFrame) -> DataFrame:
    """Rows, columns and missing values in total."""
    nulls = F.expr(f"bigint({_null_tally(df)})")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("n_nulls"),
    )


def null_bands(df: DataFrame, bands: Sequence[int] = (30, 50)) -> DataFrame:
    """Rows with any gap and rows above each percentage of gaps, as count and percent of all rows."""
    any_gap = F.expr(f"{_null_tally(df)} > 0")
    marked = add_null_profile(df.withColumn("__any", any_gap))
    n = F.count(F.lit(1))
    counts = {"any_null": F.count_if("__any")}
    counts |= {f"over_{b}": F.count_if(F.col("null_percent") > b) for b in bands}
    return marked.agg(
        n.alias("n_rows"),
        *[c.alias(f"{k}_rows") for k, c in counts.items()],
        *[(F.try_divide(c, n) * 100).alias(f"{k}_percent") for k, c in counts.items()],
    )


# --- classes ----------------------------------------------------------------------------------


def class_shares(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(class, n, percent)."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    # The window runs over one row per class.
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(W.partitionBy()))


def distinct_labels(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.select(target).distinct().orderBy(target)


# --- statistics -------------------------------------------------------------------------------


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max), exact quartiles."""
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    stats = long_values(df, columns).groupBy("pos").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    cut = {f"q{p}": at_position([quartiles[c][i] for c in columns], kind="double") for i, p in enumerate((25, 50, 75))}
    return stats.select(
        at_position(columns).alias("column"), "count", "mean", "std", "min",
        *[v.alias(k) for k, v in cut.items()], "max",
    )


def column_stats(df: DataFrame, columns: Sequence[str] | None = None, **labels: str) -> DataFrame:
    """(labels..., column, mean, median, std, min, max, skewness, kurtosis, missing_percent)."""
    columns = return_columns(df) if columns is None else list(columns)
    medians = column_quantiles(df, columns, [0.5])
    x = F.col("value")
    stats = long_values(df, columns).groupBy("pos").agg(
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        skewness(x).alias("skewness"),
        kurtosis(x).alias("kurtosis"),
        (F.avg(x.isNull().cast("int")) * 100).alias("missing_percent"),
    )
    return stats.select(
        *[F.lit(v).alias(k) for k, v in labels.items()],
        at_position(columns).alias("column"),
        "mean",
        at_position([medians[c][0] for c in columns], kind="double").alias("median"),
        "std", "min", "max", "skewness", "kurtosis", "missing_percent",
    )


def compare_column_stats(datasets: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`column_stats` of several datasets under a ``strategy`` label."""
    parts = [column_stats(df, columns, strategy=key) for key, df in datasets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pivot_statistic(stats: DataFrame, statistic: str, strategies: Sequence[str]) -> DataFrame:
    """One column per strategy. The value list is given, so no extra job looks for it."""
    return stats.groupBy("column").pivot("strategy", list(strategies)).agg(F.first(statistic))


# --- distributions ----------------------------------------------------------------------------


def trim_bounds(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> dict[str, tuple[float, float]]:
    """[q01 - reach * (q99 - q01), q99 + reach * (q99 - q01)] per column."""
    cuts = column_quantiles(df, columns, [0.01, 0.99])
    return {
        c: (low - reach * (high - low), high + reach * (high - low))
        for c, (low, high) in cuts.items()
        if low is not None
    }


def trim_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Rows whose value lies within the trim bounds."""
    bounds = trim_bounds(df, [column], reach)
    if column not in bounds:
        return df.where(F.lit(False))
    low, high = bounds[column]
    return df.where(F.col(column).between(F.lit(low), F.lit(high)))


def histograms(
    df: DataFrame, columns: Sequence[str], bins: int = 50, bounds: Mapping[str, tuple[float, float]] | None = None,
    **labels: str,
) -> DataFrame:
    """(labels..., column, bin, low, high, n). Values outside given ``bounds`` are trimmed first; the
    bins then span what is left, the last one closed."""
    columns = list(columns)
    values = long_values(df, columns).where(F.col("value").isNotNull())
    if bounds is not None:
        low = at_position([bounds.get(c, (None, None))[0] for c in columns], kind="double")
        high = at_position([bounds.get(c, (None, None))[1] for c in columns], kind="double")
        values = values.where((F.col("value") >= low) & (F.col("value") <= high))
    span = {r["pos"]: (r["lo"], r["hi"]) for r in values.groupBy("pos").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    lo = at_position([span.get(i, (None, None))[0] for i in range(len(columns))], kind="double")
    hi = at_position([span.get(i, (None, None))[1] for i in range(len(columns))], kind="double")
    binned = values.withColumns({"lo": lo, "hi": hi})
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(0))
    counted = binned.groupBy("pos", "lo", "hi", F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        *[F.lit(v).alias(k) for k, v in labels.items()],
        at_position(columns).alias("column"),
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        "n",
    )


def distribution_report(
    datasets: Mapping[str, DataFrame], columns: Sequence[str], bins: int = 50
) -> tuple[DataFrame, DataFrame]:
    """(statistics, trimmed histograms) per strategy and column. The missing share counts before trimming."""
    stats = compare_column_stats(datasets, columns).select(
        "strategy", "column", "mean", "median", "std", "missing_percent"
    )
    shapes = None
    for key, df in datasets.items():
        part = histograms(df, columns, bins, trim_bounds(df, columns), strategy=key)
        shapes = part if shapes is None else shapes.unionByName(part)
    return stats, shapes
