"""Blocks of rows that a task holds, met by rows that stream past them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VISITORS = 256  # rows that meet a block together

Rows = dict[str, np.ndarray | list]
Answer = Callable[[Rows, Rows], Iterator[pa.RecordBatch]]


def pack_vectors(df: DataFrame, column: str) -> DataFrame:
    """``column`` (array of double, no nulls) as little-endian doubles in a binary, which numpy reads without a copy a number."""
    kinds = [f for f in df.schema.fields if f.name != column]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), f"`{column}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            flat, ends = lists.values.to_numpy().tobytes(), lists.offsets.to_numpy().tolist()
            packed = pa.array([flat[8 * a:8 * b] for a, b in zip(ends, ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kinds), packed], names=[*(f.name for f in kinds), column])

    return df.mapInArrow(run, schema)


def matrix(packed: Sequence[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), width)


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> Rows:
    return {c: batch.column(c).to_pylist() if pa.types.is_binary(batch.column(c).type) else batch.column(c).to_numpy(zero_copy_only=False)
            for c in names}


def meet(
    held: DataFrame, visitors: DataFrame, keys: Sequence[str], answer: Answer, schema: str,
    finish: Callable[[Rows], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """What ``answer(block, visitors)`` yields for the rows of each key: the rows of ``held``, which must be few enough for a task,
    against the rows of ``visitors``, at most VISITORS at a time. Both have the same columns. Keys without held rows are skipped.
    What ``finish(block)`` yields follows the last visitors of a key; ``answer`` may keep something in the block for it.
    """
    names = [c for c in held.columns if c not in keys]
    kind = "__kind"
    both = held.withColumn(kind, F.lit(0)).unionByName(visitors.withColumn(kind, F.lit(1)))
    dealt = both.repartition(*keys).sortWithinPartitions(*keys, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, [], None
        for batch in batches:
            marks = list(zip(*(batch.column(c).to_pylist() for c in (*keys, kind))))
            begun = 0
            while begun < len(marks):
                end, limit = begun, begun + (VISITORS if marks[begun][-1] else len(marks))
                while end < len(marks) and end < limit and marks[end] == marks[begun]:
                    end += 1
                if marks[begun][:-1] != now:
                    if finish and block is not None:
                        yield from finish(block)
                    now, parts, block = marks[begun][:-1], [], None
                rows = batch.slice(begun, end - begun)
                if marks[begun][-1] == 0:
                    parts.append(_columns(rows, names))
                elif parts:
                    if block is None:
                        block = {c: np.concatenate([p[c] for p in parts]) if isinstance(parts[0][c], np.ndarray)
                                 else [x for p in parts for x in p[c]] for c in names}
                    yield from answer(block, _columns(rows, names))
                begun = end
        if finish and block is not None:
            yield from finish(block)

    return dealt.mapInArrow(run, schema)
