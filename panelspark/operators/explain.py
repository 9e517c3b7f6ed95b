"""What a fitted model pays attention to."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.operators.models import FEATURES, LABEL, PREDICTION
from panelspark.operators.profile import at_position
from panelspark.schema import KEY

BUCKET_ROWS = 4096


# --- built-in importance ----------------------------------------------------------------------


def _importance_vector(model) -> np.ndarray | None:
    if isinstance(model, PipelineModel):
        return _importance_vector(model.stages[-1])
    if isinstance(model, OneVsRestModel):
        parts = [_importance_vector(m) for m in model.models]
        return None if any(p is None for p in parts) else np.mean(parts, axis=0)
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    if hasattr(model, "coefficientMatrix"):
        return np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    if hasattr(model, "coefficients"):
        return np.abs(model.coefficients.toArray())
    return None


def builtin_importance(model, columns: Sequence[str], spark) -> DataFrame | None:
    """(feature, importance), largest first; None if the model has neither importances nor coefficients."""
    values = _importance_vector(model)
    if values is None or len(values) != len(columns):
        return None
    rows = [(c, float(v)) for c, v in zip(columns, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


# --- permutation importance -------------------------------------------------------------------


def _random_partner(df: DataFrame, columns: Sequence[str], seed: int, rows: int) -> DataFrame:
    """Give each row the values of another row, using every row exactly once.

    Rows fall into random buckets of a few thousand; inside a bucket, in random order, each row
    takes the values of the next one and the last those of the first. This is a permutation of
    the whole table without ever ordering it in one place.
    """
    buckets = max(1, rows // BUCKET_ROWS)
    draw = F.xxhash64(F.lit(seed), F.col(KEY))
    marked = df.withColumns({"__bucket": F.pmod(draw, F.lit(buckets)), "__turn": F.xxhash64(F.lit(seed + 1), F.col(KEY))})
    ring = W.partitionBy("__bucket").orderBy("__turn", KEY)
    first = ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    taken = {f"partner_{c}": F.coalesce(F.lead(c).over(ring), F.first(c).over(first)) for c in columns}
    return marked.withColumns(taken).drop("__bucket", "__turn")


def _swap(x: Column, partner: Column, position: Column) -> Column:
    return F.transform(x, lambda v, i: F.when(i == position, F.get(partner, i)).otherwise(v))


def permutation_importance(model, data: DataFrame, columns: Sequence[str], repeats: int = 10, seed: int = 42) -> DataFrame:
    """(feature, importance, std): mean drop of accuracy when one column is permuted.

    ``data`` has the key, features and label. All columns of a repeat are scored in one pass.
    """
    columns = list(columns)
    base = data.select(KEY, LABEL, vector_to_array(FEATURES).alias("x"))
    rows = base.count()
    hit = (F.col(LABEL) == F.col(PREDICTION)).cast("double")
    baseline = model.transform(data).agg(F.avg(hit)).first()[0]
    if baseline is None:
        raise ValueError("no rows to score")
    drops = None
    for repeat in range(repeats):
        paired = _random_partner(base, ["x"], seed + 2 * repeat, rows)
        position = F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))).alias("pos")
        changed = paired.select(LABEL, "x", "partner_x", position).select(
            LABEL, "pos", array_to_vector(_swap(F.col("x"), F.col("partner_x"), F.col("pos"))).alias(FEATURES)
        )
        score = model.transform(changed).groupBy("pos").agg((F.lit(baseline) - F.avg(hit)).alias("drop"))
        drops = score if drops is None else drops.unionByName(score)
    return (
        drops.groupBy("pos")
        .agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))
        .select(at_position(columns).alias("feature"), "importance", "std")
        .orderBy(F.col("importance").desc(), "feature")
    )


# --- class scores -----------------------------------------------------------------------------


def class_scores(model, df: DataFrame) -> DataFrame:
    """Adds ``scores``: the class probabilities, or a softmax of raw scores where there are none."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        return scored.withColumn("scores", vector_to_array("probability"))
    raised = S.let("top", "array_max(__raw)", "transform(__raw, v -> exp(v - top))")
    share = S.let("e", raised, S.let("whole", S.total("e"), "transform(e, v -> v / whole)"))
    return scored.withColumn("__raw", vector_to_array("rawPrediction")).withColumn("scores", F.expr(share)).drop("__raw")


# --- Shapley values ---------------------------------------------------------------------------


def shapley_attributions(
    model, data: DataFrame, columns: Sequence[str], permutations: int = 8, seed: int = 42
) -> DataFrame:
    """(ID, class, feature, value, attribution) by sampling feature orders (Strumbelj and Kononenko, 2014).

    For each row and order, features switch one after the other from a random other row's values
    to the row's own; the change of a class score at a switch is credited to that feature. Credits
    of one order add up to the difference between the two rows' scores.
    """
    columns = list(columns)
    width = len(columns)
    base = data.select(KEY, vector_to_array(FEATURES).alias("x"))
    rows = base.count()
    walks = None
    for p in range(permutations):
        part = _random_partner(base, ["x"], seed + 2 * p, rows).withColumn("walk", F.lit(p))
        walks = part if walks is None else walks.unionByName(part)
    place = F.sequence(F.lit(0), F.lit(width - 1))
    order = F.transform(
        F.array_sort(F.transform(place, lambda i: F.struct(F.xxhash64(F.lit(seed), F.col(KEY), F.col("walk"), i).alias("h"), i.alias("i")))),
        lambda s: s["i"],
    )
    walks = walks.withColumn("order", order).withColumn(
        # turn[i]: after how many switches feature i has its own value
        "turn", F.transform(place, lambda i: F.array_position(F.col("order"), i))
    )
    steps = walks.select("*", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("step"))
    mixed = F.transform(
        place, lambda i: F.when(F.get("turn", i) <= F.col("step"), F.get("x", i)).otherwise(F.get("partner_x", i))
    )
    points = steps.select(KEY, "walk", "order", "step", array_to_vector(mixed).alias(FEATURES))
    scored = class_scores(model, points).select(KEY, "walk", "order", "step", "scores")
    # width + 1 steps per walk meet here.
    trace = scored.groupBy(KEY, "walk", "order").agg(F.array_sort(F.collect_list(F.struct("step", "scores"))).alias("t"))
    each = trace.select(KEY, "walk", F.posexplode("order").alias("pos", "feature_pos"), "t").select(
        KEY, "feature_pos", F.get("t.scores", F.col("pos") + 1).alias("after"), F.get("t.scores", F.col("pos")).alias("before")
    )
    change = F.zip_with("after", "before", lambda a, b: a - b)
    credits = each.select(KEY, "feature_pos", F.posexplode(change).alias("class", "change"))
    mean = credits.groupBy(KEY, "class", "feature_pos").agg(F.avg("change").alias("attribution"))
    return mean.join(base, KEY).select(
        KEY, "class", at_position(columns, "feature_pos").alias("feature"),
        F.get("x", F.col("feature_pos")).alias("value"), "attribution",
    )


def attribution_ranking(attributions: DataFrame) -> DataFrame:
    """(feature, importance): mean absolute attribution, summed over the classes."""
    per_class = attributions.groupBy("feature", "class").agg(F.avg(F.abs("attribution")).alias("m"))
    return per_class.groupBy("feature").agg(F.sum("m").alias("importance")).orderBy(F.col("importance").desc(), "feature")


def attribution_dependence(attributions: DataFrame, feature: str, colour_by: str | None = None) -> DataFrame:
    """(ID, class, value, attribution[, colour]) of one feature, with another feature's value if wanted."""
    own = attributions.where(F.col("feature") == feature).select(KEY, "class", "value", "attribution")
    if colour_by is None:
        return own
    other = attributions.where(F.col("feature") == colour_by).select(KEY, "class", F.col("value").alias("colour"))
    return own.join(other, [KEY, "class"])


# --- local surrogate --------------------------------------------------------------------------


def _normal_draw(*parts: Column) -> Column:
    """Standard normal number that depends on its arguments only (Box-Muller over two hashes)."""
    def unit(tag: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(tag), *parts), F.lit(2**52)) + 0.5) / F.lit(float(2**52))

    return F.sqrt(-2.0 * F.log(unit(1))) * F.cos(2.0 * math.pi * unit(2))


def local_surrogate(
    model, instances: DataFrame, columns: Sequence[str], scales: Sequence[float],
    samples: int = 1000, top: int = 10, seed: int = 42,
) -> DataFrame:
    """(ID, class, feature, weight, rank): a kernel-weighted ridge fit around each instance.

    ``instances`` has the key and features; ``scales`` are the columns' standard deviations.
    Each instance is perturbed ``samples`` times and its group is exactly that large.
    """
    columns, width = list(columns), len(columns)
    spread = F.array(*[F.lit(float(s)) for s in scales])
    base = instances.select(KEY, vector_to_array(FEATURES).alias("x"))
    drawn = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("draw"))
    place = F.sequence(F.lit(0), F.lit(width - 1))
    noise = F.transform(place, lambda i: F.when(F.col("draw") == 0, 0.0).otherwise(_normal_draw(F.lit(seed), F.col(KEY), F.col("draw"), i)))
    drawn = drawn.withColumn("z", noise)
    moved = F.zip_with(F.col("x"), F.zip_with("z", spread, lambda z, s: z * s), lambda x, d: x + d)
    scored = class_scores(model, drawn.withColumn(FEATURES, array_to_vector(moved))).select(KEY, "z", "scores")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        z, y = np.stack(frame["z"].to_numpy()), np.stack(frame["scores"].to_numpy())
        kernel = np.exp(-(z**2).sum(axis=1) / (0.75**2 * width))
        design = np.hstack([np.ones((len(z), 1)), z])
        weighted = design * kernel[:, None]
        penalty = np.eye(width + 1)
        penalty[0, 0] = 0.0
        beta = np.linalg.solve(design.T @ weighted + penalty, weighted.T @ y)[1:]
        out = []
        for c in range(y.shape[1]):
            order = np.argsort(-np.abs(beta[:, c]), kind="stable")[:top]
            out += [(int(frame[KEY].iloc[0]), c, columns[j], float(beta[j, c]), r) for r, j in enumerate(order, start=1)]
        return pd.DataFrame(out, columns=[KEY, "class", "feature", "weight", "rank"])

    return scored.groupBy(KEY).applyInPandas(fit, f"{KEY} long, class int, feature string, weight double, rank int")
