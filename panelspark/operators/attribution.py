"""Exact Shapley values of boosted trees.

The game of a row: a set of known columns is worth the trees' expected margin where known columns follow the row and the others go
both ways, by the shares of the training weight (cover). For one leaf this is a product over the columns of its path: 1 or 0 for a
known column, as the row can reach the leaf or not, the share for an unknown one. So the Shapley values that a leaf gives depend
on the row by one bit a path column only. For all 2^m patterns of these bits and all leaves with m path columns the
values are worked out once, with the weights of the subsets gathered by size as coefficients of a polynomial; a row then
looks its pattern up. A model is turned into such tables once a task, and rows are attributed a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators.boosting import BINS, BoostedTreesModel, Trees, binned
from panelspark.operators.explain import at_position
from panelspark.operators.models import FEATURES
from panelspark.schema import KEY

DEEPEST = 12  # columns on a path; a leaf has 2^m patterns


@dataclass
class Leaves:
    """Leaves of one class whose paths have the same number of columns m."""

    columns: np.ndarray  # (leaf, m)
    reach: np.ndarray  # (leaf, m, bin): whether a row with that bin in that column can reach the leaf
    credit: np.ndarray  # (leaf, 2^m, m): attribution by pattern


def paths(tree: Trees) -> Iterator[tuple[dict[int, tuple[np.ndarray, float]], float]]:
    """For each leaf its path columns, with the bins that reach it and their share of the cover, and its value."""
    todo: list[tuple[int, dict]] = [(0, {})]
    while todo:
        node, path = todo.pop()
        column = int(tree.column[node])
        if column < 0:
            yield path, float(tree.value[node])
            continue
        left = np.arange(BINS) <= tree.split[node]
        left[0] = tree.missing_left[node]
        reach, share = path.get(column, (np.ones(BINS, bool), 1.0))
        for child, goes in ((2 * node + 1, left), (2 * node + 2, ~left)):
            todo.append((child, path | {column: (reach & goes, share * tree.cover[child] / tree.cover[node])}))


def credits(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaf, 2^m, m): Shapley values of products; ``share`` (leaf, m), bit j of a pattern says that column j leads to the leaf."""
    leaves, m = share.shape
    bit = (np.arange(2**m)[:, None] >> np.arange(m) & 1).astype(float)
    weight = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
    out = np.empty((leaves, 2**m, m))
    for i in range(m):
        # poly[..., s]: over the sets of s other columns, the sum of products of known bits and unknown shares.
        poly = np.zeros((leaves, 2**m, m))
        poly[..., 0] = 1
        for j in range(m):
            if j != i:
                known = np.zeros_like(poly)
                known[..., 1:] = poly[..., :-1] * bit[None, :, j, None]
                poly = poly * share[:, None, j, None] + known
        out[..., i] = (poly @ weight) * (bit[None, :, i] - share[:, None, i]) * value[:, None]
    return out


def leaf_tables(trees: Trees, classes: int) -> tuple[list[list[Leaves]], np.ndarray]:
    """Per class its leaves by number of path columns, and the expected margin."""
    base, tables = np.zeros(classes), []
    for k in range(classes):
        by_size: dict[int, list] = {}
        for round_ in range(len(trees.column)):
            for path, value in paths(trees[round_, k]):
                base[k] += value * np.prod([share for _, share in path.values()])
                if path and value:
                    by_size.setdefault(len(path), []).append((path, value))
        found = []
        for m, leaves in sorted(by_size.items()):
            if m > DEEPEST:
                raise ValueError(f"a path has {m} columns, {DEEPEST} at most are attributed")
            share = np.array([[s for _, s in path.values()] for path, _ in leaves])
            found.append(Leaves(np.array([list(path) for path, _ in leaves]), np.array([[r for r, _ in path.values()] for path, _ in leaves]),
                                credits(share, np.array([v for _, v in leaves]))))
        tables.append(found)
    return tables, base


def attribute(bins: np.ndarray, tables: list[list[Leaves]]) -> np.ndarray:
    """(row, class, column) Shapley values."""
    out = np.zeros((len(bins), len(tables), bins.shape[1]))
    for k, groups in enumerate(tables):
        for group in groups:
            m = group.columns.shape[1]
            for leaf, columns in enumerate(group.columns):
                pattern = np.zeros(len(bins), np.int64)
                for j, c in enumerate(columns):
                    pattern |= group.reach[leaf, j][bins[:, c]].astype(np.int64) << j
                # A leaf names a column once, so columns can be added to together.
                out[:, k, columns[:m]] += group.credit[leaf][pattern]
    return out


@lru_cache(maxsize=2)
def _tables_of(name: str, parts: tuple, shape: tuple, classes: int):
    kinds = [np.int32, np.int32, bool, float, float, float]
    return leaf_tables(Trees(*(np.frombuffer(p, k).reshape(shape) for p, k in zip(parts, kinds))), classes)


def tree_attributions(model: BoostedTreesModel, data: DataFrame, columns: Sequence[str], keep: Sequence[str] = (KEY,)) -> DataFrame:
    """(keep..., class, base, attributions): base, the expected margin, plus the attributions (by column) is the row's margin."""
    trees, edges, classes = model.trees, model.edges, model.numClasses
    if len(columns) != len(edges):
        raise ValueError("the model has another number of columns")
    parts = tuple(p.tobytes() for p in (trees.column, trees.split, trees.missing_left, trees.value, trees.cover, trees.gain))
    shape, name = trees.column.shape, model.uid
    rows = data.select(*keep, vector_to_array(FEATURES).alias("__x"))
    kept = [rows.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("class", T.IntegerType()), T.StructField("base", T.DoubleType()),
                           T.StructField("attributions", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, base = _tables_of(name, parts, shape, classes)
        for batch in batches:
            for at in range(0, len(batch), 2048):
                rows = batch.slice(at, 2048)
                x = rows.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(edges))
                found = attribute(binned(x, edges), tables)
                n = len(rows) * classes
                taken = rows.take(pa.array(np.repeat(np.arange(len(rows)), classes)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(edges), pa.int32()), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(c) for c in keep), pa.array(np.tile(np.arange(classes), len(rows)), pa.int32()), pa.array(np.tile(base, len(rows))), lists],
                    names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def by_feature(attributions: DataFrame, data: DataFrame, columns: Sequence[str], key: str = KEY) -> DataFrame:
    """(key, class, feature, value, attribution), one row a feature."""
    long = attributions.select(key, "class", F.posexplode("attributions").alias("feature_pos", "attribution"))
    values = data.select(key, vector_to_array(FEATURES).alias("__x"))
    return long.join(values, key).select(
        key, "class", at_position(list(columns), "feature_pos").alias("feature"), F.get("__x", F.col("feature_pos")).alias("value"), "attribution")
