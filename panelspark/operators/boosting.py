"""Gradient-boosted trees for several classes: softmax loss, second order, binned columns.

Columns are binned at quantiles (bin 0: missing). A round grows one tree a class, all of them together, level by level: each task
adds up gradients and hessians of its rows by (tree, node, column, bin), the sums of a (tree, node) meet in one task, which
finds its best split with the sums on its left, and one row a node goes to the driver; leaves under the last splits need no pass. Sums are whole numbers (gradients to 30 binary places), so they don't
depend on how rows are dealt, and neither do the trees. Rows live in blocks of BLOCK; their margins are moved on once a round, by its
trees alone, cached for the next one's levels and stored every STORED rounds. A table of one block needs no exchange: its task grows all the
trees, which for so few rows takes less time than an exchange a level.

A split sends missing values to the side where they gain more, and splits less than ``gamma`` or leaving less hessian than
``min_child`` on a side are not made. Rows and columns are sampled for each round and tree by hashes of row key and column, never by
position. Trees are complete binary layouts in flat arrays (children of i: 2i + 1 and 2i + 2), evaluated for all rows of a
batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.schema import KEY
from panelspark.sources.scratch import stored

BINS = 256
BLOCK = 1 << 19
STORED = 10  # rounds between two writes of the margins
UNIT = float(1 << 30)
RANK_ERROR = 1e-3  # of the quantiles that bins end at


@dataclass(frozen=True)
class Growth:
    """How trees are grown."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    rows: float = 1.0  # share of rows a round
    columns: float = 1.0  # share of columns a tree
    ridge: float = 1.0
    gamma: float = 0.0
    min_child: float = 1.0
    seed: int = 42


@dataclass
class Trees:
    """``column`` is -1 at a leaf; a row goes left if its bin is at most ``split``, or if missing, where ``missing_left``."""

    column: np.ndarray
    split: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, shape: tuple[int, ...], depth: int) -> Trees:
        size = (*shape, 2 ** (depth + 1) - 1)
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, bool), np.zeros(size), np.zeros(size), np.zeros(size))

    def __getitem__(self, at) -> Trees:
        return Trees(*(getattr(self, f)[at] for f in ("column", "split", "missing_left", "value", "cover", "gain")))

    @classmethod
    def stack(cls, parts: list[Trees]) -> Trees:
        return cls(*(np.stack([getattr(p, f) for p in parts]) for f in ("column", "split", "missing_left", "value", "cover", "gain")))


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit numbers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sampled_rows(keys: np.ndarray, growth: Growth, round_: int) -> np.ndarray:
    if growth.rows >= 1:
        return np.ones(len(keys), bool)
    salt = mixed(np.array([growth.seed * 1_000_003 + round_], np.uint64))
    return (mixed(keys ^ salt) >> np.uint64(11)) < growth.rows * 2**53


def sampled_columns(width: int, growth: Growth, round_: int, tree: int) -> np.ndarray:
    chosen = np.zeros(width, bool)
    salt = mixed(np.array([(growth.seed * 1_000_003 + round_) * 1009 + tree + 1], np.uint64))
    order = np.argsort(mixed(np.arange(width, dtype=np.uint64) ^ salt), kind="stable")
    chosen[order[:max(1, int(growth.columns * width))]] = True
    return chosen


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for c, e in enumerate(edges):
        x = values[:, c]
        out[:, c] = np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, "left"))
    return out


def places(bins: np.ndarray, tree: Trees) -> np.ndarray:
    """Node of each row in one tree."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(int(np.log2(len(tree.column) + 1)) - 1):
        column = tree.column[at]
        inner = column >= 0
        if not inner.any():
            break
        b = bins[rows, np.maximum(column, 0)]
        left = np.where(b == 0, tree.missing_left[at], b <= tree.split[at])
        at = np.where(inner, 2 * at + 2 - left, at)
    return at


def add_margins(margin: np.ndarray, bins: np.ndarray, trees: Trees) -> None:
    """Adds rounds of trees (round, class, node) to the margins."""
    for round_ in range(len(trees.column)):
        for k in range(margin.shape[1]):
            tree = trees[round_, k]
            margin[:, k] += tree.value[places(bins, tree)]


def probabilities(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the softmax loss by row and class, in whole units."""
    p = probabilities(margin)
    g = p.copy()
    g[np.arange(len(p)), label] -= 1
    return np.rint(g * UNIT), np.rint(np.maximum(2 * p * (1 - p), 1e-9) * UNIT)


def histogram(bins: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int) -> np.ndarray:
    """(node, column, bin, 2) sums; rows with a negative node are left out."""
    used = node >= 0
    some = None if used.all() else np.flatnonzero(used)
    if some is not None:
        node, g, h = node[some], g[some], h[some]
    first = node * BINS
    out = np.empty((nodes, bins.shape[1], BINS, 2), np.int64)
    for c in range(bins.shape[1]):
        # A column at a time: its sums stay in the processor's cache.
        cell = first + (bins[:, c] if some is None else bins[:, c].take(some))
        for i, w in enumerate((g, h)):
            out[:, c, :, i] = np.bincount(cell, w, nodes * BINS).reshape(nodes, BINS)
    return out


def histogram_below(above: np.ndarray, bins: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``histogram`` of a level from that of the level ``above``: of two children the one with fewer rows is summed, the other is the rest."""
    rows = np.bincount(node[node >= 0], minlength=2 * len(above))
    fewer = 2 * np.arange(len(above)) + (rows[0::2] > rows[1::2])
    parent = np.where((node >= 0) & (fewer[node >> 1] == node), node >> 1, -1)
    out = np.empty((2 * len(above), *above.shape[1:]), np.int64)
    out[fewer] = histogram(bins, parent, g, h, len(above))
    out[fewer ^ 1] = above - out[fewer]
    return out


def best_split(sums: np.ndarray, columns: np.ndarray, growth: Growth) -> tuple:
    """(gain, column, bin, missing left, G, H) of one node's sums (column, bin, 2); column -1: none. Ties go to the lower column,
    then bin, then missing to the left."""
    total = sums[0].sum(axis=0)
    whole = total / UNIT

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g ** 2 / (h + growth.ridge + 1e-300)

    best, floor = (growth.gamma, -1, 0, False), max(growth.min_child, 1e-9)
    if whole[1] < 2 * floor:
        return (*best, int(total[0]), int(total[1]))
    present = [np.cumsum(sums[:, 1:, i], axis=1)[:, :-1] for i in range(2)]
    for missing_left in (True, False) if sums[:, 0].any() else (True,):
        g, h = ((p + sums[:, :1, i] if missing_left else p) / UNIT for i, p in enumerate(present))
        g_, h_ = whole[0] - g, whole[1] - h
        gain = (score(g, h) + score(g_, h_) - score(whole[0], whole[1])) / 2
        gain[(h < floor) | (h_ < floor) | ~columns[:, None]] = -np.inf
        at = np.unravel_index(int(np.argmax(gain)), gain.shape)
        # Gains equal to ten digits are ties.
        if gain[at] > best[0] + 1e-10 * abs(best[0]) + 1e-12:
            best = (float(gain[at]), int(at[0]), int(at[1]) + 1, missing_left)
    return (*best, int(total[0]), int(total[1]))
    missing = sums[:, :1]
    present = np.cumsum(sums[:, 1:], axis=1)[:, :-1]
    for missing_left in (True, False) if missing.any() else (True,):
        left = (present + missing if missing_left else present) / UNIT
        right = whole - left
        gain = (score(left) + score(right) - score(whole[None, None])) / 2
        gain[(left[..., 1] < floor) | (right[..., 1] < floor) | ~columns[:, None]] = -np.inf
        at = np.unravel_index(int(np.argmax(gain)), gain.shape)
        # Gains equal to ten digits are ties.
        if gain[at] > best[0] + 1e-10 * abs(best[0]) + 1e-12:
            best = (float(gain[at]), int(at[0]), int(at[1]) + 1, missing_left)
    return (*best, int(total[0]), int(total[1]))


def left_sums(sums: np.ndarray, found: tuple) -> tuple[int, int]:
    """Gradients and hessians left of a node's best split, in whole units."""
    _, column, split, missing_left, _, _ = found
    if column < 0:
        return 0, 0
    left = sums[column, 0 if missing_left else 1:split + 1].sum(axis=0)
    return int(left[0]), int(left[1])


def _settle(tree: Trees, node: int, found: tuple, growth: Growth, last: bool) -> None:
    """Write what was found for a node into its tree."""
    gain, column, split, missing_left, g, h = found
    tree.cover[node] = h / UNIT
    tree.value[node] = -g / UNIT / (h / UNIT + growth.ridge + 1e-300) * growth.rate
    if column >= 0 and not last:
        tree.column[node], tree.split[node], tree.missing_left[node], tree.gain[node] = column, split, missing_left, gain


def _settle_level(tree: Trees, level: int, found: list[tuple[int, tuple, tuple]], growth: Growth) -> None:
    """(node of the level, best split, left sums) of all nodes into the tree. The leaves below the last splits follow from these."""
    first, bottom = 2**level - 1, level + 1 == growth.depth
    for i, split, left in found:
        _settle(tree, first + i, split, growth, level == growth.depth)
        if bottom and split[1] >= 0:
            g, h = split[4:]
            for side, sums in enumerate((left, (g - left[0], h - left[1]))):
                _settle(tree, 2 * (first + i) + 1 + side, (0.0, -1, 0, False, *sums), growth, True)


def _at_level(tree: Trees, bins: np.ndarray, chosen: np.ndarray, level: int) -> np.ndarray:
    """For each row its node counted inside the level, -1 if not sampled or in a leaf above."""
    node = places(bins, tree) - (2**level - 1)
    return np.where(chosen & (node >= 0), node, -1)


def grow_in_task(bins: np.ndarray, label: np.ndarray, keys: np.ndarray, classes: int, growth: Growth) -> Trees:
    """All trees of a table of one block."""
    margin, done = np.zeros((len(bins), classes)), []
    bins = np.asfortranarray(bins)
    for round_ in range(growth.rounds):
        g, h = gradients(margin, label)
        trees, chosen = Trees.empty((classes,), growth.depth), sampled_rows(keys, growth, round_)
        for k in range(classes):
            tree, columns = trees[k], sampled_columns(bins.shape[1], growth, round_, k)
            for level in range(max(growth.depth, 1)):
                node = _at_level(tree, bins, chosen, level)
                if (node < 0).all():
                    break
                found = []
                sums = histogram_below(sums, bins, node, g[:, k], h[:, k]) if level else histogram(bins, node, g[:, k], h[:, k], 1)
                for i in np.unique(node[node >= 0]).tolist():
                    split = best_split(sums[i], columns, growth)
                    found.append((i, split, left_sums(sums[i], split)))
                _settle_level(tree, level, found, growth)
        done.append(trees)
        add_margins(margin, bins, Trees.stack([trees]))
    return Trees.stack(done) if done else Trees.empty((0, classes), growth.depth)


# --- many blocks --------------------------------------------------------------------------------

BLOCKS = "block long, keys binary, label binary, bins binary, margin binary"


def _unpacked(batch: pa.RecordBatch, width: int, classes: int) -> Iterator[tuple]:
    for keys, label, bins, margin in zip(*(batch.column(c).to_pylist() for c in ("keys", "label", "bins", "margin"))):
        label = np.frombuffer(label, np.uint8)
        yield (np.frombuffer(keys, np.uint64), label, np.frombuffer(bins, np.uint8).reshape(len(label), width),
               np.frombuffer(margin, "<f8").reshape(len(label), classes).copy())


def _blocks(edges: list[np.ndarray], classes: int):
    """Rows (key, label, x) to blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, n = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            keys, label, bins = (np.concatenate(x) for x in zip(*held))
            row = [first + n, keys.tobytes(), label.tobytes(), bins.tobytes(), np.zeros((len(keys), classes)).tobytes()]
            types = [pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["block", "keys", "label", "bins", "margin"])

        for batch in batches:
            x = batch.column("x").values.to_numpy(zero_copy_only=False).reshape(len(batch), len(edges)) if len(batch) else np.zeros((0, len(edges)))
            if len(batch):
                held.append((batch.column("key").to_numpy().view(np.uint64), batch.column("label").to_numpy().astype(np.uint8), binned(x, edges)))
            if sum(len(h[0]) for h in held) >= BLOCK:
                yield block()
                held, n = [], n + 1
        if held:
            yield block()

    return run


@dataclass
class _Boosting:
    """Rounds over many blocks."""

    blocks: DataFrame
    width: int
    classes: int
    growth: Growth
    done: list[Trees] = field(default_factory=list)

    def _move_margins(self) -> None:
        """Blocks with the margins after the last round, kept for the levels of the next; written every STORED rounds."""
        last, width, classes = Trees.stack(self.done[-1:]), self.width, self.classes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margins = []
                for _, _, bins, margin in _unpacked(batch, width, classes):
                    add_margins(margin, bins, last)
                    margins.append(margin.tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margins, pa.binary())], names=batch.schema.names)

        before, moved = self.blocks, self.blocks.mapInArrow(run, BLOCKS)
        if len(self.done) % STORED == 0:
            self.blocks = stored(moved, "margins")
            before.unpersist()
            self.blocks.persist()
        else:
            self.blocks = moved.persist()
            self._spent = before

    def _level(self, trees: Trees, level: int) -> list[tuple]:
        """(class, node, *best split, *left sums) of every node of a level."""
        width, classes, growth, round_ = self.width, self.classes, self.growth, len(self.done)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                for keys, label, bins, margin in _unpacked(batch, width, classes):
                    g, h = gradients(margin, label)
                    chosen, bins = sampled_rows(keys, growth, round_), np.asfortranarray(bins)
                    own = np.stack([histogram(bins, _at_level(trees[k], bins, chosen, level), g[:, k], h[:, k], 2**level) for k in range(classes)])
                    sums = own if sums is None else sums + own
            if sums is not None:
                k, node = np.nonzero(sums[..., 1].any(axis=(2, 3)))
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(node, pa.int32()), pa.array([sums[a, b].tobytes() for a, b in zip(k, node)], pa.binary())],
                                                 names=["k", "node", "sums"])

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for k, node, sums in zip(*(batch.column(c).to_pylist() for c in ("k", "node", "sums"))):
                    own = np.frombuffer(sums, np.int64).reshape(width, BINS, 2)
                    total[k, node] = total[k, node] + own if (k, node) in total else own
            rows = []
            for (k, node), s in total.items():
                split = best_split(s, sampled_columns(width, growth, round_, k), growth)
                rows.append((k, node, *split, *left_sums(s, split)))
            if rows:
                types = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["k", "node", "gain", "col", "split", "missing_left", "g", "h", "lg", "lh"])

        context = self.blocks.sparkSession.sparkContext
        tasks = min(classes * 2**level, max(context.defaultParallelism, 1))
        added = self.blocks.mapInArrow(add, "k int, node int, sums binary").repartition(tasks, "k", "node")
        found = added.mapInArrow(best, "k int, node int, gain double, col int, split int, missing_left boolean, g long, h long, lg long, lh long")
        return [tuple(r) for r in found.collect()]  # at most a row a node of the level

    def run(self) -> Trees:
        self._spent = None
        self.blocks.persist()
        try:
            for round_ in range(self.growth.rounds):
                trees = Trees.empty((self.classes,), self.growth.depth)
                for level in range(max(self.growth.depth, 1)):
                    found = self._level(trees, level)
                    if self._spent is not None:  # the first level has filled what replaces it
                        self._spent.unpersist()
                        self._spent = None
                    if not found:
                        break
                    for k in range(self.classes):
                        _settle_level(trees[k], level, [(r[1], r[2:8], r[8:]) for r in found if r[0] == k], self.growth)
                self.done.append(trees)
                if round_ + 1 < self.growth.rounds:
                    self._move_margins()
        finally:
            if self._spent is not None:
                self._spent.unpersist()
            self.blocks.unpersist()
        return Trees.stack(self.done) if self.done else Trees.empty((0, self.classes), self.growth.depth)


def _grow_one(width: int, classes: int, growth: Growth):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, label, bins, _ in _unpacked(batch, width, classes):
                trees = grow_in_task(bins, label, keys, classes, growth)
                parts = [trees.column, trees.split, trees.missing_left, trees.value, trees.cover, trees.gain]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in parts], pa.binary())], names=["part"])

    return run


# --- estimator ----------------------------------------------------------------------------------


class BoostedTreesModel(Model):
    """``trees`` (round, class, node) over bins that end at ``edges``."""

    def __init__(self, trees: Trees, edges: list[np.ndarray], classes: int, featuresCol: str, predictionCol: str, probabilityCol: str):
        super().__init__()
        self.trees, self.edges, self.numClasses = trees, edges, classes
        self.featuresCol, self.predictionCol, self.probabilityCol = featuresCol, predictionCol, probabilityCol

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each column in the gain of all splits."""
        inner = self.trees.column >= 0
        total = np.bincount(self.trees.column[inner], self.trees.gain[inner], len(self.edges))
        return DenseVector(total / (total.sum() or 1.0))

    def margins(self, values: np.ndarray) -> np.ndarray:
        margin = np.zeros((len(values), self.numClasses))
        add_margins(margin, binned(values, self.edges), self.trees)
        return margin

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, edges, classes = self.trees, self.edges, self.numClasses

        @F.pandas_udf("array<double>")
        def chances(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if len(batch):
                    margin = np.zeros((len(batch), classes))
                    add_margins(margin, binned(np.stack(batch.to_numpy()), edges), trees)
                    yield pd.Series(list(probabilities(margin)))
                else:
                    yield pd.Series([], dtype=object)

        scored = df.withColumn(self.probabilityCol, chances(vector_to_array(F.col(self.featuresCol))))
        top = F.array_position(self.probabilityCol, F.array_max(self.probabilityCol)) - 1
        return scored.withColumn(self.predictionCol, top.cast("double")).withColumn(self.probabilityCol, array_to_vector(self.probabilityCol))


class BoostedTrees(Estimator):
    """Softmax boosting of the label column (0, 1, ...) on the vector column; rows without a label are left out.

    ``keyCol`` tells rows apart for row sampling; without such a column in the table a hash of the row does, so equal rows are
    sampled together.
    """

    def __init__(self, growth: Growth = Growth(), classes: int = 3, featuresCol: str = "features", labelCol: str = "label",
                 predictionCol: str = "prediction", probabilityCol: str = "probability", keyCol: str = KEY):
        super().__init__()
        self.growth, self.classes, self.keyCol = growth, classes, keyCol
        self.featuresCol, self.labelCol, self.predictionCol, self.probabilityCol = featuresCol, labelCol, predictionCol, probabilityCol

    def _edges(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        """At most BINS - 2 bin ends a column, at quantiles; infinities are values like others, NaN is missing."""
        shares = np.linspace(0, 1, BINS - 1)[:-1].tolist()
        names = [f"c{i}" for i in range(width)]
        found: list[list[float]] = []
        for at in range(0, width, 100):
            part = names[at:at + 100]
            columns = [F.when(~F.isnan(F.col("x")[at + i]), F.col("x")[at + i]).alias(c) for i, c in enumerate(part)]
            found += rows.select(*columns).approxQuantile(part, shares, RANK_ERROR)
        return [np.unique(np.array(f, float)) for f in found]

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        x = vector_to_array(F.col(self.featuresCol))
        key = F.xxhash64(self.keyCol) if self.keyCol in df.columns else F.xxhash64(x, self.labelCol)
        rows = stored(df.select(key.alias("key"), F.col(self.labelCol).cast("int").alias("label"), x.alias("x")).where(F.col("label").isNotNull()), "boosting-rows")
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
        if not n:
            raise ValueError("no rows with a label")
        edges = self._edges(rows, width)
        one = n <= BLOCK
        dealt = rows.coalesce(1).sortWithinPartitions("key", "x", "label") if one else rows.repartition(
            max(-(-n // BLOCK), df.sparkSession.sparkContext.defaultParallelism), "key")
        blocks = stored(dealt.mapInArrow(_blocks(edges, self.classes), BLOCKS), "blocks")
        if one:
            parts = [r["part"] for r in blocks.mapInArrow(_grow_one(width, self.classes, self.growth), "part binary").collect()]
            shape = (self.growth.rounds, self.classes, 2 ** (self.growth.depth + 1) - 1)
            kinds = [np.int32, np.int32, bool, float, float, float]
            trees = Trees(*(np.frombuffer(p, k).reshape(shape).copy() for p, k in zip(parts, kinds)))
        else:
            trees = _Boosting(blocks, width, self.classes, self.growth).run()
        return BoostedTreesModel(trees, edges, self.classes, self.featuresCol, self.predictionCol, self.probabilityCol)
