"""Mutual information of a class and a column by nearest neighbours (Ross, 2014).

For each value the distance to the k-th nearest value of its own class is its radius, and m counts the values of all classes that lie
nearer than that (those equal to it, if the radius is 0). With N values, N_c of the class and psi the digamma function,
the estimate is psi(N) + mean psi(k) - mean psi(N_c) - mean psi(m), 0 at least.

Equal values of a class are one row with a weight. They are ranked by ranges of (column, class, value); blocks of BLOCK ranks get the
k ranks before and behind them as a halo, so every radius is found inside a block. The bounds of a value's
neighbourhood, the last doubles whose distance is under the radius, are then looked up among all values of the column by
running sums of weights along ranges of (column, place): a value counts as often as it stands before the upper bound less
before the lower one. No task holds a column or a class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.operators.order import rank_within, sum_before
from panelspark.operators.profile import at_position
from panelspark.schema import TARGET
from panelspark.sources.scratch import stored

BLOCK = 65_536
SHIFT = 8  # digamma is taken that far up, where its series is exact to 1e-12


def digamma(n: Column) -> Column:
    """Digamma of positive numbers."""
    x = n.cast("double") + SHIFT
    square = 1 / (x * x)
    series = square * (F.lit(1 / 12) - square * (F.lit(1 / 120) - square * (F.lit(1 / 252) - square * (F.lit(1 / 240) - square / 132))))
    below = sum((1 / (n + i) for i in range(1, SHIFT)), 1 / n.cast("double"))
    return F.log(x) - 1 / (2 * x) - series - below


def radii(values: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Distance of each of the ascending distinct ``values`` from its k-th nearest, ``weights`` copies counted."""
    copies = np.minimum(weights, k + 1)
    flat, first = np.repeat(values, copies), np.cumsum(copies) - copies
    found = np.full(len(values), np.inf)
    for before in range(k + 1):
        lo, hi = first - before, first - before + k
        fits = (lo >= 0) & (hi < len(flat))
        lo, hi = np.maximum(lo, 0), np.minimum(hi, len(flat) - 1)
        reach = np.maximum(values - flat[lo], flat[hi] - values)
        found = np.where(fits, np.minimum(found, reach), found)
    return found


def _as_order(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles, neighbours one apart."""
    bits = x.view(np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits, bits)


def _from_order(n: np.ndarray) -> np.ndarray:
    return np.where(n < 0, np.int64(-(2**63)) - n, n).astype(np.int64).view(np.float64)


def reach(values: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last double nearer to each value than its radius, or the value itself."""
    values = values + 0.0
    bounds = []
    for sign in (-1, 1):
        near = _as_order(values)
        far = _as_order(values + sign * 2 * radius + sign * np.finfo(float).tiny)
        for _ in range(64):
            middle = (near >> 1) + (far >> 1) + (near & far & 1)
            inside = sign * (_from_order(middle) - values) < radius
            near, far = np.where(inside, middle, near), np.where(inside, far, middle)
        bounds.append(_from_order(near) + 0.0)
    return bounds[0], bounds[1]


def _neighbourhoods(k: int):
    """Rows sorted by (pos, class, block, value), halos included, to their bounds."""
    names = ["pos", "class", "value", "n", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bounds(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            value, n, of = (rows.column(c).to_numpy() for c in ("value", "n", "of"))
            own = rows.column("own").to_numpy(zero_copy_only=False)
            lo, hi = reach(value, radii(value, n, int(min(k, of[0] - 1))))
            kept = rows.filter(pa.array(own))
            return pa.RecordBatch.from_arrays([*(kept.column(c) for c in names[:4]), pa.array(lo[own]), pa.array(hi[own])], names=names)

        now, held = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("pos", "class", "block"))))
            begun = 0
            for i, key in enumerate(keys):
                if key != now:
                    if now is not None:
                        yield bounds([*held, batch.slice(begun, i - begun)])
                    now, held, begun = key, [], i
            held.append(batch.slice(begun))
        if now is not None:
            yield bounds(held)

    return run


def nearest_information(df: DataFrame, columns: Sequence[str], target: str = TARGET, k: int = 3) -> DataFrame:
    """(feature, score): mutual information in nats. Missing values and rows without a class are left out, and so are classes with
    a single value of a column."""
    columns = list(columns)
    cells = df.where(F.col(target).isNotNull()).select(F.col(target).alias("class"), F.posexplode(S.pack(columns)).alias("pos", "value"))
    present = cells.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("value", F.col("value") + F.lit(0.0))
    distinct = stored(present.groupBy("pos", "class", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    sizes = distinct.groupBy("pos", "class").agg(F.sum("n").alias("of")).where("of > 1")  # a row a column and class
    used = distinct.join(sizes, ["pos", "class"])

    ranked = rank_within(used, ["pos", "class"], ["value"]).withColumn("block", F.expr(f"rank div {BLOCK}"))
    inside = F.col("rank") % BLOCK
    homes = F.array_compact(F.array(
        F.struct(F.col("block").alias("block"), F.lit(True).alias("own")),
        F.when(inside < k, F.struct((F.col("block") - 1).alias("block"), F.lit(False).alias("own"))),
        F.when(inside >= BLOCK - k, F.struct((F.col("block") + 1).alias("block"), F.lit(False).alias("own")))))
    # Halos of blocks that don't exist have no rows of their own, which is all that comes of them.
    dealt = ranked.select("pos", "class", "value", "n", "of", F.inline(homes)).repartition("pos", "class", "block")
    dealt = dealt.sortWithinPartitions("pos", "class", "block", "value")
    kinds = {f.name: f.dataType.simpleString() for f in used.schema.fields}
    schema = f"pos int, class {kinds['class']}, value double, n long, lo double, hi double"
    near = dealt.mapInArrow(_neighbourhoods(k), schema).withColumn("q", F.monotonically_increasing_id())
    near = stored(near, "neighbourhoods")

    none = F.lit(None).cast("long")
    values = used.groupBy("pos", "value").agg(F.sum("n").alias("w")).select("pos", F.col("value").alias("x"), F.lit(1).alias("kind"), "w", none.alias("q"))
    below = near.select("pos", F.col("lo").alias("x"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("w"), "q")
    above = near.select("pos", F.col("hi").alias("x"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("w"), "q")
    found = sum_before(values.unionByName(below).unionByName(above), ["pos"], ["x", "kind"], "w")
    m = found.where("q IS NOT NULL").groupBy("q").agg(F.sum(F.when(F.col("kind") == 2, F.col("before")).otherwise(-F.col("before"))).alias("m"))
    terms = near.join(m, "q").groupBy("pos").agg(F.sum(F.col("n") * digamma(F.col("m"))).alias("near"))

    of = F.col("of")
    classes = sizes.groupBy("pos").agg(
        F.sum("of").alias("whole"), F.sum(of * (digamma(F.least(of - 1, F.lit(k))) - digamma(of))).alias("own"))
    score = digamma(F.col("whole")) + (F.col("own") - F.col("near")) / F.col("whole")
    scored = classes.join(terms, "pos").select("pos", F.greatest(score, F.lit(0.0)).alias("score"))
    every = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("pos"))
    return every.join(scored, "pos", "left").select(at_position(columns).alias("feature"), "score")
