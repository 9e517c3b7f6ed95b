"""Feature ranking and comparison of rankings. A ranking is (method, feature, score, rank)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.functions.quantiles import column_quantiles
from panelspark.functions.sketch import f_tail
from panelspark.operators.correlate import target_correlations
from panelspark.operators.information import nearest_information
from panelspark.operators.profile import at_position
from panelspark.schema import TARGET, literal_array


def _ranked(scores: DataFrame, method: str, top_n: int | None = None, *extra: str) -> DataFrame:
    """Best score first, undefined scores last, ties (to 12 digits, so that the order of a sum does
    not decide) by name. One row per feature, so the unpartitioned window is small."""
    order = W.partitionBy().orderBy(F.round("score", 12).desc_nulls_last(), "feature")
    out = scores.select(F.lit(method).alias("method"), "feature", "score", *extra, F.row_number().over(order).alias("rank"))
    return out if top_n is None else out.where(F.col("rank") <= top_n)


def rank_by_correlation(df: DataFrame, columns: Sequence[str], target: str = TARGET, top_n: int | None = None) -> DataFrame:
    """By abs(correlation with the target); the signed value is kept as ``corr``."""
    scores = target_correlations(df, columns, target).select(
        F.col("column").alias("feature"), "corr", F.abs("corr").alias("score")
    )
    return _ranked(scores, "correlation", top_n, "corr")


def important_features(df: DataFrame, columns: Sequence[str], target: str = TARGET, threshold: float = 0.05) -> DataFrame:
    """Features whose abs(correlation) exceeds a threshold."""
    return rank_by_correlation(df, columns, target).where(F.col("score") > threshold)


def _by_class(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(pos, class, n, mean, var) per column and class."""
    labelled = df.where(F.col(target).isNotNull())
    values = labelled.select(F.col(target).alias("class"), F.posexplode(S.pack(columns)).alias("pos", "value"))
    return values.where(F.col("value").isNotNull()).groupBy("pos", "class").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var")
    )


def anova_scores(df: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    """(feature, score, df_between, df_within): one-way F statistic of each column over the classes."""
    columns = list(columns)
    n, mean = F.col("n"), F.col("mean")
    # One row per column and class from here on.
    groups = _by_class(df, columns, target).withColumn(
        "grand", F.sum(n * mean).over(W.partitionBy("pos")) / F.sum(n).over(W.partitionBy("pos"))
    )
    parts = groups.groupBy("pos").agg(
        F.sum(n * (mean - F.col("grand")) * (mean - F.col("grand"))).alias("between"),
        F.sum(n * F.col("var")).alias("within"),
        (F.count(F.lit(1)) - 1).alias("df_between"),
        (F.sum(n) - F.count(F.lit(1))).alias("df_within"),
    )
    f = F.try_divide(F.try_divide("between", "df_between"), F.try_divide("within", "df_within"))
    return parts.select(at_position(columns).alias("feature"), f.alias("score"), "df_between", "df_within")


def rank_by_f_value(df: DataFrame, columns: Sequence[str], target: str = TARGET, top_n: int | None = None) -> DataFrame:
    """By ANOVA F, with p-values (computed on the driver: one number per feature)."""
    rows = anova_scores(df, columns, target).collect()
    scored = [
        (r["feature"], r["score"],
         None if r["score"] is None else f_tail(r["score"], r["df_between"], r["df_within"]))
        for r in rows
    ]
    scores = df.sparkSession.createDataFrame(scored, "feature string, score double, p_value double")
    return _ranked(scores, "f_value", top_n, "p_value")


def mutual_information(df: DataFrame, columns: Sequence[str], target: str = TARGET, bins: int = 10) -> DataFrame:
    """(feature, score): mutual information in nats between the class and the column cut at its quantiles."""
    columns = list(columns)
    labelled = df.where(F.col(target).isNotNull())
    cuts = column_quantiles(labelled, columns, [i / bins for i in range(1, bins)])
    edges = F.array(*[literal_array(sorted({float(e) for e in cuts[c] if e is not None}), "double") for c in columns])
    values = labelled.select(F.col(target).alias("class"), F.posexplode(S.pack(columns)).alias("pos", "value"))
    x = F.col("value")
    cell = F.size(F.filter(F.get(edges, F.col("pos")), lambda e: e < x))
    counts = values.where(x.isNotNull()).groupBy("pos", cell.alias("cell"), "class").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    # At most columns x bins x classes rows from here on.
    joint = counts.withColumns({
        "n_all": F.sum("n").over(W.partitionBy("pos")),
        "n_cell": F.sum("n").over(W.partitionBy("pos", "cell")),
        "n_class": F.sum("n").over(W.partitionBy("pos", "class")),
    })
    n = F.col("n")
    term = n / F.col("n_all") * F.log(n * F.col("n_all") / (F.col("n_cell") * F.col("n_class")))
    return joint.groupBy("pos").agg(F.sum(term).alias("score")).select(at_position(columns).alias("feature"), "score")


def rank_by_mutual_information(
    df: DataFrame, columns: Sequence[str], target: str = TARGET, top_n: int | None = None, bins: int = 10
) -> DataFrame:
    return _ranked(mutual_information(df, columns, target, bins), "mutual_info", top_n)


def rank_by_nearest_information(
    df: DataFrame, columns: Sequence[str], target: str = TARGET, top_n: int | None = None, k: int = 3
) -> DataFrame:
    return _ranked(nearest_information(df, columns, target, k), "mutual_info", top_n)


def best_features(importance: DataFrame, threshold: float = 0.01, max_features: int = 20) -> DataFrame:
    """Features above an importance threshold, the first ``max_features`` of them."""
    return (
        importance.where(F.col("importance") > threshold)
        .orderBy(F.col("importance").desc(), "feature")
        .limit(max_features)
    )


# --- comparing rankings -----------------------------------------------------------------------


def stack_rankings(*rankings: DataFrame) -> DataFrame:
    names = ["method", "feature", "score", "rank"]
    out = rankings[0].select(*names)
    for ranking in rankings[1:]:
        out = out.unionByName(ranking.select(*names))
    return out


def side_by_side(rankings: DataFrame, methods: Sequence[str], top_n: int = 20) -> DataFrame:
    """(rank, one column of feature names per method)."""
    top = rankings.where(F.col("rank") <= top_n)
    return top.groupBy("rank").pivot("method", list(methods)).agg(F.first("feature"))


def common_features(rankings: DataFrame, n_methods: int, top_n: int = 20) -> DataFrame:
    """Features in the top of every method."""
    top = rankings.where(F.col("rank") <= top_n)
    return top.groupBy("feature").agg(F.count_distinct("method").alias("n")).where(F.col("n") == n_methods).select("feature")


def union_features(rankings: DataFrame, top_n: int = 10) -> DataFrame:
    """Features in the top of any method."""
    return rankings.where(F.col("rank") <= top_n).select("feature").distinct()


def pair_overlaps(rankings: DataFrame, top_n: int = 20) -> DataFrame:
    """(method1, method2, overlap_count, overlap_percent, common) for every pair of methods, including
    pairs without a common feature."""
    top = rankings.where(F.col("rank") <= top_n).select("method", "feature")
    # One row per method; a ranking has as many entries as features were ranked.
    lists = top.groupBy("method").agg(F.collect_set("feature").alias("features"))
    one, two = lists.alias("one"), lists.alias("two")
    both = F.array_sort(F.array_intersect("one.features", "two.features"))
    return one.join(two, F.col("one.method") < F.col("two.method")).select(
        F.col("one.method").alias("method1"),
        F.col("two.method").alias("method2"),
        F.size(both).alias("overlap_count"),
        (F.size(both) * 100.0 / top_n).alias("overlap_percent"),
        F.array_join(both, ",").alias("common"),
    )
