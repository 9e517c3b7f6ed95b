"""Missing values: row filters, column choice, fills down the rows, standardisation, mean/median fill."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions.quantiles import column_quantiles
from panelspark.sources.scratch import cut_lineage
from panelspark.schema import columns_except, literal, quoted, replace_columns, return_columns


def keep_observed_rows(df: DataFrame, share: float = 0.7, n_columns: int | None = None) -> DataFrame:
    """Rows with at least ``int(share * n_columns)`` present values over all columns."""
    n = len(df.columns) if n_columns is None else n_columns
    return df.dropna(thresh=int(share * n))


def null_share(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Share of missing values per column, in one aggregate."""
    row = df.selectExpr(*[f"avg(int({quoted(c)} IS NULL))" for c in columns]).first()
    return dict(zip(columns, row))


def low_null_columns(train: DataFrame, test: DataFrame, threshold: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Keep returns that are rarely missing in ``train``; fill what is left with 0 in both."""
    returns = return_columns(train)
    shares = null_share(train, returns)
    kept = [c for c in returns if shares[c] is not None and shares[c] < threshold]
    names = columns_except(train, returns) + kept
    return train.select(*names).na.fill(0), test.select(*names).na.fill(0)


# --- down the rows ----------------------------------------------------------------------------

DOWN_METHODS = ("ffill", "bfill", "ffill_then_bfill", "bfill_then_ffill", "linear")


def fill_down(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    order: str,
    method: str = "ffill",
    ranges: int | None = None,
) -> DataFrame:
    """Fill gaps along ``order`` inside each ``by`` key; rows with a null key are a key of their own.

    A key may hold a large part of the table, so rows are dealt by ranges of (key, order) of about
    equal size, as many as there are shuffle partitions unless ``ranges`` says otherwise: windows
    run per (key, range), and each range hands one summary row (its size, first and last present
    value per column) to the others. Only those summaries, at most one a range, meet in a window
    over the whole key. Equal values of ``order`` are put in order by a hash of the row.
    """
    if method not in DOWN_METHODS:
        raise ValueError(f"unknown fill {method!r}, expected one of {DOWN_METHODS}")
    by, columns = list(by), list(columns)
    part, tie = "__part", "__tie"
    back, ahead = method != "bfill", method != "ffill"  # which directions the method looks in
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn(tie, F.xxhash64(*[F.col(quoted(c)) for c in df.columns])).repartitionByRange(n, *by, order, tie)
    # Stored, so that both uses below see the same ranges.
    base = cut_lineage(dealt.withColumn(part, F.spark_partition_id()))
    inside = W.partitionBy(*by, part).orderBy(order, tie)
    base = base.withColumn("__at", F.row_number().over(inside))

    def seen(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("__at").alias("at"), F.col(c).cast("double").alias("v")))

    # Looking ahead is looking back from the other end: frames that only grow are scanned once, whatever their size.
    outside = W.partitionBy(*by, part).orderBy(F.col("__at").desc())
    before, after = (w.rowsBetween(W.unboundedPreceding, 0) for w in (inside, outside))
    local = base.withColumns(
        {f"__prev_{c}": F.last(seen(c), ignorenulls=True).over(before) for c in columns if back}
    ).withColumns({f"__next_{c}": F.last(seen(c), ignorenulls=True).over(after) for c in columns if ahead})

    summary = base.groupBy(*by, part).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.max(seen(c)).alias(f"__last_{c}") for c in columns if back],
        *[F.min(seen(c)).alias(f"__first_{c}") for c in columns if ahead],
    )
    whole = W.partitionBy(*by)
    earlier, later = (whole.orderBy(o).rowsBetween(W.unboundedPreceding, -1) for o in (part, F.col(part).desc()))
    summary = summary.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))

    def shifted(name: str) -> Column:
        s = F.col(name)
        return F.when(
            s.isNotNull(), F.struct((s["at"] + F.col("__offset")).alias("at"), s["v"].alias("v"))
        )

    summary = summary.withColumns(
        {f"__carry_{c}": F.last(shifted(f"__last_{c}"), ignorenulls=True).over(earlier) for c in columns if back}
        | {f"__ahead_{c}": F.last(shifted(f"__first_{c}"), ignorenulls=True).over(later) for c in columns if ahead}
    )
    kept = [f"__{k}_{c}" for c in columns for k, use in (("carry", back), ("ahead", ahead)) if use]
    summary = summary.select(*[F.col(quoted(c)).alias(f"__by{i}") for i, c in enumerate(by)], F.col(part).alias("__of"), "__offset", *kept)
    same = local[part] == summary["__of"]
    for i, c in enumerate(by):
        same = same & local[c].eqNullSafe(summary[f"__by{i}"])
    joined = local.join(summary, same)

    def filled(c: str) -> Column:
        if back:
            prev = F.coalesce(shifted(f"__prev_{c}"), F.col(f"__carry_{c}"))
        if ahead:
            nxt = F.coalesce(shifted(f"__next_{c}"), F.col(f"__ahead_{c}"))
        if method == "ffill":
            return prev["v"]
        if method == "bfill":
            return nxt["v"]
        if method == "bfill_then_ffill":
            return F.coalesce(nxt["v"], prev["v"])
        if method == "ffill_then_bfill":
            return F.coalesce(prev["v"], nxt["v"])
        at = F.col("__at") + F.col("__offset")
        line = prev["v"] + (nxt["v"] - prev["v"]) * (at - prev["at"]) / (nxt["at"] - prev["at"])
        return F.coalesce(F.col(c).cast("double"), line, prev["v"], nxt["v"])

    new = {c: filled(c).alias(c) for c in columns}
    return joined.select(*[new.get(c, F.col(f"`{c}`")) for c in df.columns])


# --- standardisation and simple imputation ----------------------------------------------------


@dataclass(frozen=True)
class ColumnStats:
    mean: float | None
    std: float | None


def standardise(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, ColumnStats]]:
    """Column z-scores with the sample deviation, and the statistics to undo them."""
    row = df.selectExpr(*[f"{f}({quoted(c)})" for f in ("avg", "stddev_samp") for c in columns]).first()
    stats = {c: ColumnStats(row[i], row[len(columns) + i]) for i, c in enumerate(columns)}
    scaled = {
        c: f"try_divide({quoted(c)} - double({literal(s.mean)}), double({literal(s.std)}))" for c, s in stats.items()
    }
    return replace_columns(df, scaled), stats


def inverse_standardise(df: DataFrame, stats: dict[str, ColumnStats]) -> DataFrame:
    back = {c: f"{quoted(c)} * double({literal(s.std)}) + double({literal(s.mean)})" for c, s in stats.items()}
    return replace_columns(df, back)


def fill_with_statistic(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Replace missing values by the column mean or the exact column median."""
    if strategy == "median":
        values = {c: q[0] for c, q in column_quantiles(df, columns, [0.5]).items()}
    elif strategy == "mean":
        values = dict(zip(columns, df.selectExpr(*[f"avg({quoted(c)})" for c in columns]).first()))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.na.fill({c: v for c, v in values.items() if v is not None})
