"""Nearest-neighbour imputation on standardised values, exact, globally or inside a key.

The distance between two rows is the Euclidean one over the columns both have, scaled up by
the share of columns compared. A gap is filled with the mean of the ``k`` nearest rows that
have that column; if no row is comparable, with the column mean.

The rows of a key are cut into blocks by key hash, of about ``block_rows`` rows until there are BLOCKS of them, then larger ones up to
MOST_ROWS. A task holds a block and all rows of the key stream past it as donors; it keeps the ``k`` best of each gap and
hands on these alone, so pairs of rows are never written out and each row travels BLOCKS times, however many there are. Products in
single precision, with a bound of their error, tell which pairs can matter; these are compared exactly.
The work stays quadratic in the size of a key: that is what an exact answer costs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.operators.meet import Rows, matrix, meet, pack_vectors
from panelspark.schema import KEY, literal_array, quoted, replace_columns, return_columns

BLOCKS = 64
MOST_ROWS = 32_768
TOGETHER = 1024  # rows of a block that are compared at a time
FIRST = 32  # donors compared before any gap has candidates
ERROR = 4e-5  # bounds the error of a squared distance in single precision, as a share of both squared lengths

_CANDIDATE = "id long, feature int, distance double, donor long, value double"


def impute_neighbours(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    by: Sequence[str] = (),
    k: int = 5,
    block_rows: int = 2048,
) -> DataFrame:
    """Fill gaps of ``columns``; ``by`` restricts donors (and the statistics) to the same key."""
    columns = return_columns(df) if columns is None else list(columns)
    by = list(by)
    width = len(columns)
    packed = df.withColumn("__r", S.pack(columns))

    def each(function: str) -> str:
        return f"array({', '.join(f'{function}({quoted(c)})' for c in columns)})"

    stats = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"), F.expr(each("avg")).alias("__mean"), F.expr(each("stddev_samp")).alias("__std")
    )
    if by:
        # Rows with a null key are a key of their own.
        named = stats.withColumnsRenamed({c: f"__by{i}" for i, c in enumerate(by)})
        same = [packed[c].eqNullSafe(named[f"__by{i}"]) for i, c in enumerate(by)]
        rows = packed.join(named, reduce(and_, same)).drop(*[f"__by{i}" for i in range(len(by))])
    else:
        whole = stats.first()
        rows = packed.withColumns(
            {"__n": F.lit(whole["__n"])}
            | {c: literal_array(whole[c], "double") for c in ("__mean", "__std")}
        )
    place = F.sequence(F.lit(0), F.lit(width - 1))
    z = F.transform(
        place,
        # A constant column has no scale; every present value then sits at 0.
        lambda i: F.coalesce(
            F.try_divide(F.get("__r", i) - F.get("__mean", i), F.get("__std", i)),
            F.when(F.get("__r", i).isNotNull(), F.lit(0.0)),
        ),
    )
    blocks = f"int(greatest(least(ceil(__n / {block_rows}), {BLOCKS}), ceil(__n / {MOST_ROWS})))"
    rows = rows.withColumns({"__z": z, "__blocks": F.expr(blocks)})
    named_by = [F.col(c).alias(f"__by{i}") for i, c in enumerate(by)]
    packed_rows = pack_vectors(
        rows.select(F.col(KEY).cast("long").alias("id"), *named_by, F.pmod(F.xxhash64(KEY), F.col("__blocks")).cast("int").alias("block"),
                    F.col("__blocks").alias("blocks"), F.transform("__z", lambda v: F.coalesce(v, F.lit(float("nan")))).alias("z")), "z")
    keys = [*(f"__by{i}" for i in range(len(by))), "block"]
    # Rows without an id get no neighbours' mean; as donors they come after others at the same distance.
    queries = packed_rows.where(F.col("id").isNotNull()).select(*keys, "id", "z")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    donors = packed_rows.select(*keys[:-1], every, F.coalesce("id", F.lit(np.iinfo(np.int64).max)).alias("id"), "z")
    candidates = meet(queries, donors, keys, _compare(width, k), _CANDIDATE, _found(width))
    rank = F.row_number().over(W.partitionBy("id", "feature").orderBy("distance", "donor"))
    means = (
        candidates.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .groupBy("id", "feature")
        .agg(F.avg("value").alias("value"))
        .groupBy("id")
        .agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("found"))
    )
    means = means.select(F.col("id").alias("__id"), "found")
    filled = F.transform(
        place,
        lambda i: F.coalesce(
            F.get("__r", i),
            F.try_element_at("found", i) * F.coalesce(F.get("__std", i), F.lit(0.0)) + F.get("__mean", i),
            F.get("__mean", i),
        ),
    )
    # Whole rows are carried along, so a repeated id stays as often as it was.
    joined = rows.join(means, rows[KEY] == means["__id"], "left").select(*df.columns, filled.alias("__filled"))
    return replace_columns(joined, S.unpack("__filled", columns), ["__filled"])


class _Queries:
    """Rows with gaps and the up to k nearest donors of every gap so far."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int):
        some = np.isnan(values).any(axis=1)
        self.ids, self.values, self.k = ids[some], values[some], k
        self.has = ~np.isnan(self.values)
        shape = (*self.values.shape, k)
        self.distance, self.donor, self.value = np.full(shape, np.inf), np.zeros(shape, np.int64), np.zeros(shape)
        # Distance of the last candidate of each gap: what a further one must not exceed.
        self.limit = np.where(self.has, -np.inf, np.inf)
        flat, bare = self.has.astype(np.float32), np.where(self.has, self.values, 0)
        self.squares = bare**2
        size = self.squares.sum(axis=1, keepdims=True)
        self.left = np.hstack([self.squares, flat, -2 * bare, -ERROR * size, np.ones((len(bare), 1))]).astype(np.float32)

    def meet(self, ids: np.ndarray, values: np.ndarray) -> None:
        has, width = ~np.isnan(values), values.shape[1]
        flat, bare = has.astype(np.float32), np.where(has, values, 0)
        size = (bare**2).sum(axis=1, keepdims=True)
        right = np.hstack([flat, bare**2, bare, np.ones((len(bare), 1)), -ERROR * size]).astype(np.float32).T
        for at in range(0, len(self.ids), TOGETHER):
            part = slice(at, at + TOGETHER)
            furthest = self.limit[part].max(axis=1)
            known = np.isfinite(furthest)
            limit = np.where(known, (furthest * (1 + 1e-6) + 1e-6) ** 2 / width * (1 + ERROR), 0.0)[:, None]
            # Squares less the limit's square for each column shared: one product tells all pairs that can matter.
            self.left[part, :width] = self.squares[part] - limit * self.has[part]
            near = self.left[part] @ right <= 0
            near[~known] = True
            # In flat places, which numpy finds many times faster than places in two dimensions.
            i, j = np.divmod(np.flatnonzero(near), len(ids))
            if len(i):
                self._take(i + at, j, ids, values, has)

    def _take(self, i: np.ndarray, j: np.ndarray, ids: np.ndarray, values: np.ndarray, has: np.ndarray) -> None:
        both = self.has[i] & has[j]
        shared = both.sum(axis=1)
        off = np.where(both, self.values[i] - values[j], 0.0)
        with np.errstate(invalid="ignore", divide="ignore"):
            distance = np.round(np.sqrt((off * off).sum(axis=1) * values.shape[1] / shared), 12)
        # Donors at the limit count, as ties are settled by donor id.
        width, k = values.shape[1], self.k
        useful = (distance[:, None] <= self.limit[i]) & has[j] & np.isfinite(distance)[:, None]
        pair, feature = np.divmod(np.flatnonzero(useful), width)
        if not len(pair):
            return
        cell = i[pair] * width + feature
        held = np.unique(cell)
        row, column = held // width, held % width
        cells = np.concatenate([np.repeat(held, k), cell])
        distances = np.concatenate([self.distance[row, column].ravel(), distance[pair]])
        donors = np.concatenate([self.donor[row, column].ravel(), ids[j[pair]]])
        found = np.concatenate([self.value[row, column].ravel(), values[j[pair], feature]])
        order = np.lexsort((donors, distances, cells))
        cells = cells[order]
        first = np.searchsorted(cells, held)
        best = order[first[:, None] + np.arange(k)]
        self.distance[row, column], self.donor[row, column], self.value[row, column] = distances[best], donors[best], found[best]
        self.limit[row, column] = distances[best[:, -1]]


def _compare(width: int, k: int):
    def answer(block: Rows, visitors: Rows) -> Iterator[pa.RecordBatch]:
        begun = "queries" in block
        if not begun:
            block["queries"] = _Queries(block["id"], matrix(block["z"], width), k)
        ids, values = visitors["id"], matrix(visitors["z"], width)
        step = len(ids) if begun else FIRST
        for at in range(0, len(ids), step):
            block["queries"].meet(ids[at:at + step], values[at:at + step])
        yield from ()

    return answer


def _found(width: int):
    def finish(block: Rows) -> Iterator[pa.RecordBatch]:
        queries = block["queries"]
        for at in range(0, len(queries.ids), TOGETHER):
            part = slice(at, at + TOGETHER)
            row, feature, place = np.nonzero(np.isfinite(queries.distance[part]))
            at_cell = (row + at, feature, place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.ids[row + at]), pa.array(feature.astype(np.int32)), pa.array(queries.distance[at_cell]),
                 pa.array(queries.donor[at_cell]), pa.array(queries.value[at_cell])],
                names=["id", "feature", "distance", "donor", "value"])

    return finish
