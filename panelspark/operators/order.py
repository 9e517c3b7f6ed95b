"""Exact places inside keys of any size, without a task that holds a whole key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.schema import quoted
from panelspark.sources.scratch import stored


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Each name with underscores in front until no column of ``df`` has it in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """Adds ``rank``, the place of a row from 0 along ``order`` among the rows of its ``by`` key, and ``total``, their number.

    Rows are dealt by ranges of (by, order), so a key that holds a third of the table lies in many tasks; each
    (key, range) hands its count to the others, one row a range. Nulls come first and null keys are a key of their own.
    Rows equal in ``order`` lie in one range, in any order: end ``order`` with a column that tells them apart.
    """
    by = list(by)
    at, part, first, count, before = free_names(df, "at", "part", "first", "count", "before")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(quoted(c)).asc_nulls_first() for c in (*by, *order)]
    dealt = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    numbered = stored(dealt.withColumn(at, F.monotonically_increasing_id()), "ranked").withColumn(part, F.shiftright(at, 33))

    own = [F.col(quoted(c)) for c in by]
    sizes = numbered.groupBy(*own, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(count))
    whole = W.partitionBy(*(own or [F.lit(0)]))
    earlier = whole.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        *[c.alias(f"{before}_{i}") for i, c in enumerate(own)], F.col(part).alias(f"{before}_part"),
        (F.coalesce(F.sum(count).over(earlier), F.lit(0)) - F.col(first)).alias(before), F.sum(count).over(whole).alias(total))
    same = F.col(part) == F.col(f"{before}_part")
    for i, c in enumerate(own):
        same = same & c.eqNullSafe(F.col(f"{before}_{i}"))
    return numbered.join(sizes, same).select(
        *[F.col(quoted(c)) for c in df.columns], (F.col(at) + F.col(before)).alias(rank), F.col(total))


def sum_before(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str, name: str = "before") -> DataFrame:
    """Adds ``name``, the sum of the long column ``weight`` over the rows before a row along ``order`` in its ``by`` key.

    Ranges as in ``rank_within``; each range adds up as it streams and hands one sum a key to the others.
    """
    by = list(by)
    run, part, first, own, shift = free_names(df, "run", "part", "first", "own", "shift")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(quoted(c)).asc_nulls_first() for c in (*by, *order)]
    dealt = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    schema = dealt.withColumns({run: F.lit(0).cast("long"), part: F.lit(0)}).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, number = 0, TaskContext.get().partitionId()
        for batch in batches:
            w = batch.column(weight).to_numpy()
            before = total + np.cumsum(w) - w
            total += int(w.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before, pa.int64()), pa.array(np.full(len(w), number), pa.int32())], names=schema.fieldNames())

    summed = stored(dealt.mapInArrow(add, schema), "sums")
    columns = [F.col(quoted(c)) for c in by]
    sizes = summed.groupBy(*columns, part).agg(F.min(run).alias(first), F.sum(weight).alias(own))
    earlier = W.partitionBy(*(columns or [F.lit(0)])).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(*[c.alias(f"{shift}_{i}") for i, c in enumerate(columns)], F.col(part).alias(f"{shift}_part"),
                         (F.coalesce(F.sum(own).over(earlier), F.lit(0)) - F.col(first)).alias(shift))
    same = F.col(part) == F.col(f"{shift}_part")
    for i, c in enumerate(columns):
        same = same & c.eqNullSafe(F.col(f"{shift}_{i}"))
    return summed.join(sizes, same).select(*[F.col(quoted(c)) for c in df.columns], (F.col(run) + F.col(shift)).alias(name))
