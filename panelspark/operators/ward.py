"""Agglomerative clustering with Ward's criterion, exact for any number of rows.

Clusters are features (weight, mean, spread around it); at first each distinct row is one, with the number of its copies as weight. In a round
every cluster finds the one it costs least to merge with, and all pairs that are each other's nearest are merged. Ward's criterion is
reducible: a merge brings no third cluster closer, so these are merges that the closest-pair method makes as well, and a
cluster whose nearest one was not merged keeps it. Clusters that have to look anew are cut into blocks of ROWS at most, which tasks hold
while all clusters stream past; products in single precision tell which pairs can matter, these are worked out exactly. Work is
quadratic in the distinct rows, memory is not. HELD clusters at most are merged in one task, by a chain of nearest neighbours. Once
FEATURES are left at most, they go to the driver, which builds the rest of the tree in the same way.

The tree is cut at its ``k - 1`` highest merges, wherever they were made; rows find their cluster by following the merges below.
Costs that are equal are ordered by the hashes of the rows, so the result doesn't depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.meet import Rows, matrix, meet, pack_vectors
from panelspark.operators.order import free_names, rank_within
from panelspark.sources.scratch import stored

FEATURES = 1024
ROWS = 16_384  # clusters that a task holds while others stream past
HELD = 4096  # clusters whose costs a task holds, each with each
FIRST = 32  # clusters compared before any has a nearest one
TOGETHER = 65_536  # pairs worked out at a time
NONE = np.iinfo(np.int64).max
CLUSTER = "id long, w double, v binary, spread double, top double"


@dataclass
class Features:
    weight: np.ndarray
    mean: np.ndarray
    spread: np.ndarray  # sum of squared distances of the rows from the mean

    def __len__(self) -> int:
        return len(self.weight)


def ward_tree(features: Features) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) by ascending height; a and b are features, which stand for the groups they are in by then.

    Height is the growth of the sum of squares. A chain of nearest neighbours is followed until two are each other's nearest;
    Ward's criterion is reducible, so merging these at once gives the same tree as merging the closest pair each time.
    """
    n = len(features)
    weight = features.weight.astype(float).copy()
    mean = features.mean.astype(float)
    cost = np.empty((n, n))
    for i in range(n):
        off = mean[:i + 1] - mean[i]
        cost[i, :i + 1] = cost[:i + 1, i] = weight[:i + 1] * weight[i] / (weight[:i + 1] + weight[i]) * np.einsum("ij,ij->i", off, off)
    np.fill_diagonal(cost, np.inf)
    # Rows of ``cost`` hold the heights of the groups that are left, inf for others; a merge gets its row from those of both
    # parts (Lance and Williams, 1967).
    alive, merges, chain = np.ones(n, bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.argmax(alive)))
        while True:
            top = chain[-1]
            near = int(np.argmin(cost[top]))
            if len(chain) > 1 and cost[top, chain[-2]] <= cost[top, near]:
                break
            chain.append(near)
        a, b = sorted((chain.pop(), chain.pop()))
        height = cost[a, b]
        merges.append((a, b, float(height)))
        alive[b] = False
        joined = ((weight[a] + weight) * cost[a] + (weight[b] + weight) * cost[b] - weight * height) / (weight[a] + weight[b] + weight)
        weight[a] += weight[b]
        joined[~alive] = np.inf
        joined[a] = np.inf
        cost[a], cost[:, a], cost[:, b] = joined, joined, np.inf
    return sorted(merges, key=lambda m: m[2])


def cut(n: int, merges: list[tuple[int, int, float]], k: int) -> np.ndarray:
    """Group of each feature, numbered from 0 by least member, after all but the ``k - 1`` highest merges."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b, _ in merges[:max(n - k, 0)]:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return np.unique([find(x) for x in range(n)], return_inverse=True)[1]


class _Nearest:
    """Clusters and the nearest of those they have met."""

    def __init__(self, ids: np.ndarray, weight: np.ndarray, mean: np.ndarray):
        self.ids, self.weight, self.mean = ids, weight, mean
        self.cost, self.low, self.high = np.full(len(ids), np.inf), np.full(len(ids), NONE), np.full(len(ids), NONE)
        self.error = (mean.shape[1] + 64) * 2.0**-21  # bounds that of a squared distance in single precision, as a share of what it is the difference of
        self.shift = mean.mean(axis=0)
        off = mean - self.shift
        self.size = (off * off).sum(axis=1)
        self.left = np.hstack([-2 * off, np.zeros((len(ids), 1)), np.ones((len(ids), 1)), np.zeros((len(ids), 1))]).astype(np.float32)
        self._limit(np.arange(len(ids)))

    def _limit(self, at: np.ndarray) -> None:
        # A cost of weights a and b is at most the limit where the squared distance is at most limit / a + limit / b.
        limit = np.where(np.isfinite(self.cost[at]), self.cost[at] * (1 + self.error), 0.0)
        width = self.mean.shape[1]
        self.left[at, width], self.left[at, width + 2] = self.size[at] * (1 - self.error) - limit / self.weight[at], -limit

    def meet(self, ids: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> None:
        off = mean - self.shift
        size = (off * off).sum(axis=1, keepdims=True)
        right = np.hstack([off, np.ones((len(ids), 1)), size * (1 - self.error), 1 / weight[:, None]]).astype(np.float32).T
        near = ~(self.left @ right > 0)
        near[np.isinf(self.cost)] = True
        found = np.flatnonzero(near)
        for at in range(0, len(found), TOGETHER):
            self._take(*np.divmod(found[at:at + TOGETHER], len(ids)), ids, weight, mean)

    def _take(self, i: np.ndarray, j: np.ndarray, ids: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> None:
        other = self.ids[i] != ids[j]
        i, j = i[other], j[other]
        cost = costs(self.weight[i], self.mean[i], weight[j], mean[j])
        low, high = np.minimum(self.ids[i], ids[j]), np.maximum(self.ids[i], ids[j])
        order = np.lexsort((high, low, cost, i))
        order = order[np.concatenate([[True], np.diff(i[order]) > 0])] if len(order) else order
        i, cost, low, high = i[order], cost[order], low[order], high[order]
        own = self.cost[i], self.low[i], self.high[i]
        less = (cost < own[0]) | (cost == own[0]) & ((low < own[1]) | (low == own[1]) & (high < own[2]))
        i = i[less]
        self.cost[i], self.low[i], self.high[i] = cost[less], low[less], high[less]
        self._limit(i)


def costs(weight: np.ndarray, mean: np.ndarray, weight_: np.ndarray, mean_: np.ndarray) -> np.ndarray:
    """By how much the sum of squares grows, row by row; the same to the last bit whichever side comes first."""
    off = mean - mean_
    return weight * weight_ / (weight + weight_) * (off * off).sum(axis=1)


def nearest_clusters(asking: DataFrame, clusters: DataFrame, n: int, width: int) -> DataFrame:
    """(id, cost, low, high): the nearest of ``clusters`` for each of the ``n`` rows of ``asking`` (both id, w, v), as the pair's cost and ids."""
    def answer(block: Rows, visitors: Rows) -> Iterator[pa.RecordBatch]:
        begun = "nearest" in block
        if not begun:
            block["nearest"] = _Nearest(block["id"], block["w"], matrix(block["v"], width))
        ids, weight, mean = visitors["id"], visitors["w"], matrix(visitors["v"], width)
        edges = [0, len(ids)] if begun else [0, *range(FIRST, len(ids), FIRST), len(ids)]
        for a, b in zip(edges, edges[1:]):
            block["nearest"].meet(ids[a:b], weight[a:b], mean[a:b])
        yield from ()

    def finish(block: Rows) -> Iterator[pa.RecordBatch]:
        found = block.get("nearest")
        if found is not None:
            some = np.isfinite(found.cost)
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (found.ids, found.cost, found.low, found.high)], names=["id", "cost", "low", "high"])

    blocks = -(-n // ROWS)
    slices = -(-2 * max(asking.sparkSession.sparkContext.defaultParallelism, 1) // blocks)

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias(own)
        return df.select("id", "w", "v", place, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)).select("block", "slice", "id", "w", "v")

    held, visitors = dealt(asking, "block", blocks, "slice", slices), dealt(clusters, "slice", slices, "block", blocks)
    found = meet(held, visitors, ["block", "slice"], answer, "id long, cost double, low long, high long", finish)
    return found.groupBy("id").agg(F.min(F.struct("cost", "low", "high")).alias("m")).select("id", "m.cost", "m.low", "m.high")


def _merged(width: int):
    """Pairs of clusters (id, cost, w, v, spread, top and the same with an underscore) to the clusters they make."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names if name not in ("v", "v_")}
            v, v_ = (matrix(batch.column(name).to_pylist(), width) for name in ("v", "v_"))
            weight = c["w"] + c["w_"]
            mean = np.ascontiguousarray((c["w"][:, None] * v + c["w_"][:, None] * v_) / weight[:, None]).tobytes()
            size = 8 * width
            top = np.maximum(c["cost"], np.maximum(c["top"], c["top_"]))  # never below the merges it stands on
            yield pa.RecordBatch.from_arrays(
                [pa.array(c["id"]), pa.array(weight), pa.array([mean[i * size:(i + 1) * size] for i in range(len(weight))], pa.binary()),
                 pa.array(c["spread"] + c["spread_"] + c["cost"]), pa.array(top)], names=["id", "w", "v", "spread", "top"])

    return run


def _rest(width: int, most: int, rounds: int):
    """Clusters, few enough for a task, to the ``most`` that are left of them and, with ``other``, the merges made (``top`` is the height)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("id", "w", "v", "spread", "top")))), key=lambda r: r[0])
        ids, weight, spread, top = ([r[i] for r in held] for i in (0, 1, 3, 4))
        mean, level, gone, rows = matrix([r[2] for r in held], width).copy(), [rounds] * len(held), set(), []
        for a, b, height in ward_tree(Features(np.array(weight), mean, np.array(spread)))[:len(held) - most]:
            whole = weight[a] + weight[b]
            mean[a] = (weight[a] * mean[a] + weight[b] * mean[b]) / whole
            weight[a], spread[a], top[a] = whole, spread[a] + spread[b] + height, max(height, top[a], top[b])
            level[a] = 1 + max(level[a], level[b])
            rows.append((ids[a], None, None, None, top[a], level[a], ids[b]))
            gone.add(b)
        rows += [(ids[i], weight[i], mean[i].tobytes(), spread[i], top[i], None, None) for i in range(len(held)) if i not in gone]
        types = [pa.int64(), pa.float64(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["id", "w", "v", "spread", "top", "round", "other"])

    return run


@dataclass
class Summary:
    """The clusters that are left (``features``, named by ``ids``) after rounds of merges among all distinct ``rows`` (id, w, v). ``merges``
    (round, id, other, height) has those of all rounds; ``other`` goes on as ``id``. Without rounds there are only the features."""

    features: Features
    ids: np.ndarray
    rows: DataFrame | None = None
    merges: DataFrame | None = None
    rounds: int = 0


def summarise(rows: DataFrame, vector: str, most: int = FEATURES) -> Summary:
    """The clusters of Ward's method when ``most`` are left at most; ``vector`` is an array of doubles without gaps, of one length."""
    packed = pack_vectors(rows.select(F.col(vector).alias("v")).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))), "v")
    counted = packed.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("w"))
    distinct = stored(counted.withColumns({"spread": F.lit(0.0), "top": F.lit(0.0), "place": F.xxhash64("v", F.lit(1))}), "distinct-rows")
    n, size = distinct.agg(F.count(F.lit(1)), F.max(F.octet_length("v"))).first()
    if not n:
        return Summary(Features(np.zeros(0), np.zeros((0, 0)), np.zeros(0)), np.zeros(0, np.int64))
    if n <= most:
        return Summary(*_collected(distinct.orderBy("place", "v").withColumn("id", F.lit(0).cast("long"))))
    width = size // 8
    ranked = rank_within(distinct, [], ["place", "v"], "id", "total")
    first = now = stored(ranked.select("id", "w", "v", "spread", "top"), "clusters")
    near, logs, rounds = None, [], 0
    while n > max(most, HELD):
        if near is None:
            near = stored(nearest_clusters(now, now, n, width), "nearest-clusters")
        pairs = near.groupBy("low", "high").agg(F.min("cost").alias("cost"), F.count(F.lit(1)).alias("times")).where("times = 2").drop("times")
        pairs = stored(pairs, "merged-pairs")
        made = pairs.count()
        if not made:  # only where rounding hides whose costs are equal: the closest pair is right in any case
            pairs = stored(near.orderBy("cost", "low", "high").limit(1).select("low", "high", "cost"), "merged-pairs")
            made = pairs.count()
            if not made:
                raise ValueError("vectors are not finite, or too far apart for distances in double precision")
        n, rounds = n - made, rounds + 1
        other = now.select(*[F.col(c).alias(f"{c}_") for c in now.columns])
        both = pairs.join(now, F.col("low") == F.col("id")).join(other, F.col("high") == F.col("id_"))
        ends = pairs.select(F.explode(F.array("low", "high")).alias("end"))
        left = now.join(ends, F.col("id") == F.col("end"), "left_anti")
        now = stored(left.unionByName(both.drop("low", "high").mapInArrow(_merged(width), CLUSTER)), "clusters")
        logs.append(pairs.join(now, F.col("low") == F.col("id")).select(F.lit(rounds).alias("round"), "id", F.col("high").alias("other"), F.col("top").alias("height")))
        if n > max(most, HELD):
            partner = F.col("low") + F.col("high") - F.col("id")
            known = near.join(ends, F.col("id") == F.col("end"), "left_anti").join(ends, partner == F.col("end"), "left_anti")
            asking = now.join(known.select(F.col("id").alias("known")), F.col("id") == F.col("known"), "left_anti")
            near = stored(known.unionByName(nearest_clusters(asking, now, n - known.count(), width)), "nearest-clusters")
    if n > most:
        rest = stored(now.coalesce(1).mapInArrow(_rest(width, most, rounds), f"{CLUSTER}, round int, other long"), "rest-of-clusters")
        logs.append(rest.where("other IS NOT NULL").select("round", "id", "other", F.col("top").alias("height")))
        rounds = logs[-1].agg(F.max("round")).first()[0]
        now = rest.where("other IS NULL").select("id", "w", "v", "spread", "top")
    merges = logs[0]
    for log in logs[1:]:
        merges = merges.unionByName(log)
    return Summary(*_collected(now.orderBy("id")), first, stored(merges, "merges"), rounds)


def _collected(clusters: DataFrame) -> tuple[Features, np.ndarray]:
    found = clusters.collect()  # at most ``most`` rows
    features = Features(np.array([r["w"] for r in found]), np.array([np.frombuffer(r["v"], "<f8") for r in found]), np.array([r["spread"] for r in found]))
    return features, np.array([r["id"] for r in found], np.int64)


def _cut_rows(summary: Summary, merges: list[tuple[int, int, float]], k: int) -> tuple[DataFrame, np.ndarray]:
    """(v, label) of every distinct row and the label of each feature, after all but the ``k - 1`` highest merges of the whole tree."""
    # The rounds' merges come before those above the features, where heights are equal.
    below = summary.merges.orderBy(F.desc("height"), F.desc("round"), F.desc("id")).limit(max(k - 1, 0)).collect()
    highest = sorted([(r["height"], r["round"], i, -1) for i, r in enumerate(below)] + [(h, summary.rounds + 1, i, i) for i, (_, _, h) in enumerate(merges)])
    highest = highest[len(highest) - max(k - 1, 0):] if k > 1 else []
    undone = [below[i]["other"] for _, _, i, above in highest if above < 0]
    above = {at for _, _, _, at in highest if at >= 0}

    spark = summary.rows.sparkSession
    kept = summary.merges.select("id", "other")
    if undone:
        split = spark.createDataFrame([(int(b),) for b in undone], "split long")
        kept = kept.join(split, F.col("other") == F.col("split"), "left_anti")
    at = summary.rows.select("id").join(kept.select(F.col("id").alias("into"), "other"), F.col("id") == F.col("other"), "left").select(
        "id", F.coalesce("into", "id").alias("root"))
    at = stored(at, "roots")
    for _ in range(summary.rounds.bit_length()):  # steps to a root are at most as many as rounds, and double each time
        step = at.select(F.col("id").alias("via"), F.col("root").alias("next"))
        at = stored(at.join(step, F.col("root") == F.col("via")).select("id", F.col("next").alias("root")), "roots")
    weights = dict(at.join(summary.rows.select("id", "w"), "id").groupBy("root").agg(F.sum("w")).collect())  # a row a feature and merge undone

    names = [*summary.ids.tolist(), *sorted(undone)]
    place = {x: i for i, x in enumerate(names)}
    group = cut(len(names), [m for i, m in enumerate(merges) if i not in above], 0)
    label = _ranked(group, np.array([weights[x] for x in names]))
    labels = spark.createDataFrame([(x, float(label[i])) for x, i in place.items()], "root long, label double")
    placed = summary.rows.select("id", "v").join(at, "id").join(F.broadcast(labels), "root").select("v", "label")
    return stored(placed, "labels-of-rows"), label[:len(summary.ids)]


def _ranked(group: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Groups numbered by weight, the largest first."""
    total = np.bincount(group, weight) if len(group) else np.zeros(0)
    rank = np.empty(len(total), int)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
    return rank[group] if len(group) else group


class WardModel(Model):
    """``features`` with their cluster ``label``, the ``merges`` above them, and the ``spread`` inside them; ``rows`` has the label of each
    distinct row (v, label) if there are more of them than features. A vector that was not there goes to the cluster of its nearest feature."""

    def __init__(self, features: Features, merges: list[tuple[int, int, float]], label: np.ndarray, featuresCol: str, predictionCol: str,
                 rows: DataFrame | None = None):
        super().__init__()
        self.features, self.merges, self.label, self.rows = features, merges, label, rows
        self.spread = float(features.spread.sum())
        self.featuresCol, self.predictionCol = featuresCol, predictionCol

    def _transform(self, df: DataFrame) -> DataFrame:
        mean, label = self.features.mean, self.label

        @F.pandas_udf("double")
        def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                found = np.empty(len(batch))
                for at in range(0, len(batch), 1024):
                    x = np.stack(batch.to_numpy()[at:at + 1024])
                    d = (x * x).sum(1)[:, None] + (mean * mean).sum(1)[None, :] - 2 * (x @ mean.T)
                    found[at:at + 1024] = label[d.argmin(1)]
                yield pd.Series(found)

        vector = vector_to_array(F.col(self.featuresCol))
        if self.rows is None:
            return df.withColumn(self.predictionCol, nearest(vector))

        @F.pandas_udf("binary")
        def packed(batch: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else (np.asarray(x, "<f8") + 0.0).tobytes() for x in batch], dtype=object)

        @F.pandas_udf("double")
        def nearest_of_new(batch: pd.Series) -> pd.Series:
            found = np.full(len(batch), np.nan)
            for i, x in enumerate(batch):
                if x is not None:
                    found[i] = label[((mean - x) ** 2).sum(1).argmin()]
            return pd.Series(found)

        key, own = free_names(df, "v", "label")
        labels = self.rows.select(F.col("v").alias(key), F.col("label").alias(own))
        joined = df.withColumn(key, packed(vector)).join(labels, key, "left")
        new = nearest_of_new(F.when(F.col(own).isNull(), vector))
        return joined.withColumn(self.predictionCol, F.coalesce(F.col(own), new)).select(
            *[c for c in df.columns if c != self.predictionCol], self.predictionCol)


class WardClustering(Estimator):
    """``k`` clusters of the vector column by Ward's method; clusters are numbered by weight, the largest first."""

    def __init__(self, k: int = 3, most: int = FEATURES, featuresCol: str = "features", predictionCol: str = "prediction"):
        super().__init__()
        self.k, self.most, self.featuresCol, self.predictionCol = k, most, featuresCol, predictionCol

    def _fit(self, df: DataFrame) -> WardModel:
        summary = summarise(df.select(vector_to_array(F.col(self.featuresCol)).alias("v")), "v", self.most)
        merges = ward_tree(summary.features)
        if summary.rows is None:
            rows, label = None, _ranked(cut(len(summary.features), merges, self.k), summary.features.weight)
        else:
            rows, label = _cut_rows(summary, merges, self.k)
        return WardModel(summary.features, merges, label, self.featuresCol, self.predictionCol, rows)
