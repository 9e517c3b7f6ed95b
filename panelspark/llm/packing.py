"""Harmonic packing of tokenized documents into sequences of a fixed capacity C.

A length in (C/(k+1), C/k] belongs to class k, whose bins take exactly k pieces. A document is first cut: whole
sequences of C, then, while the rest would leave over 1/64 of a bin of its class empty, a piece of exactly
C/(k+1), which fills a slot of the next class without waste. Every worker fills the bins of each class on its own
and keeps a bin back until it has its k pieces. The pieces kept back, fewer than k a class and worker, meet in two
more rounds: by class over GROUP workers, then, over GROUP times GROUP workers, all classes together into bins
filled in turn. Nothing is gathered that grows with the corpus.

A sequence shorter than C is to be padded to C, unless its length is a power of two (``sequences`` does it).
Null text counts as empty: its document is the end id alone. Documents with null or repeated doc_id are packed like
others, one by one. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import store, text_of
from panelspark.llm.wordtokens import encode_texts, id_lists

CAPACITY = 4096
WASTE = 64  # a rest is cut once more if its class would leave over 1/WASTE of a bin empty
SHORT = 64  # a rest up to this length is not cut
GROUP = 256
PIECES = "doc_id long, start long, length long, doc_tokens long, ids array<int>"
PLACED = "sequence_id long, offset long"
FILLED = f"{PIECES}, class int, worker long, piece long, {PLACED}".replace("ids array<int>", "ids binary")
SHORT_ROWS = f"class int, worker long, piece long, length long, {PLACED}"


def class_of(length: int, capacity: int = CAPACITY) -> int:
    return capacity // length


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if rest <= SHORT or k * rest >= capacity - capacity // WASTE:
            pieces.append(rest)
            break
        pieces.append(capacity // (k + 1))
        rest -= pieces[-1]
    return pieces


class _Bins:
    """Bins of every class that are not full yet."""

    def __init__(self, first_id: int, capacity: int):
        self.next_id, self.capacity, self.open = first_id, capacity, {}

    def add(self, piece: tuple, length: int) -> list[tuple]:
        """The pieces of the bin that this one fills, each with sequence_id and offset, else none."""
        k = class_of(length, self.capacity)
        held = self.open.setdefault(k, [])
        held.append((piece, length))
        if len(held) < k:
            return []
        at, out = 0, []
        for p, n in held:
            out.append((*p, self.next_id, at))
            at += n
        self.next_id += 1
        self.open[k] = []
        return out

    def rest(self) -> list[tuple]:
        return [(*p, None, None) for held in self.open.values() for p, _ in held]


def _batch(rows: list[tuple], worker: int, capacity: int) -> pa.RecordBatch:
    doc, start, length, total, ids, piece, seq, at = zip(*rows)
    return pa.RecordBatch.from_arrays([
        pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(total, pa.int64()),
        pa.array(ids, pa.binary()), pa.array([class_of(n, capacity) for n in length], pa.int32()), pa.array([worker] * len(rows), pa.int64()),
        pa.array(piece, pa.int64()), pa.array(seq, pa.int64()), pa.array(at, pa.int64()),
    ], names=["doc_id", "start", "length", "doc_tokens", "ids", "class", "worker", "piece", "sequence_id", "offset"])


def _fill(batches: Iterator[pa.RecordBatch], tokenizer: str, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    worker = TaskContext.get().partitionId()
    bins, last = _Bins(worker << 32, capacity), np.array([end], np.uint32).tobytes()
    piece = worker << 32
    for batch in batches:
        out, size = [], 0
        docs = batch.column("doc_id").to_pylist()
        for doc, ids in zip(docs, encode_texts(batch.column("t").cast(pa.binary()).to_pylist(), tokenizer)):
            ids += last
            start, total = 0, len(ids) // 4
            for n in cut(total, capacity):
                out += bins.add((doc, start, n, total, ids[4 * start:4 * (start + n)], piece), n)
                start += n
                piece += 1
            size += len(ids)
            if size > 1 << 22 and out:
                yield _batch(out, worker, capacity)
                out, size = [], 0
        if out:
            yield _batch(out, worker, capacity)
    if rest := bins.rest():
        yield _batch(rest, worker, capacity)


Row = tuple[int, int, int, int]  # class, worker, piece, length


def _rounds(batches: Iterator[pa.RecordBatch], key: Callable[[Row], tuple], place: Callable[[Iterator[Row]], Iterator[tuple]]) -> Iterator[pa.RecordBatch]:
    """Rows, which come sorted by ``key``, streamed group by group through ``place``, which gives (row, sequence_id, offset)."""
    names = ["class", "worker", "piece", "length"]

    def rows() -> Iterator[Row]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    def batch_of(out: list) -> pa.RecordBatch:
        columns = [*zip(*(r for r, _, _ in out)), [s for _, s, _ in out], [at for _, _, at in out]]
        types = [pa.int32()] + [pa.int64()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*names, "sequence_id", "offset"])

    out: list = []
    for _, group in groupby(rows(), key):
        for placed in place(group):
            out.append(placed)
            if len(out) >= 10_000:
                yield batch_of(out)
                out = []
    if out:
        yield batch_of(out)


def _by_class(rows: Iterator[Row], capacity: int) -> Iterator[tuple]:
    """Pieces of one class of GROUP workers: full bins get an id, the last few pieces none."""
    held: list[Row] = []
    for n, row in enumerate(rows):
        held.append(row)
        k, worker = row[0], row[1]
        if len(held) == k:
            group, at = (worker // GROUP * (capacity + 1) + k) << 16, 0
            for r in held:
                yield r, (1 << 61) | (group + n // k), at
                at += r[3]
            held = []
    yield from ((r, None, None) for r in held)


def _in_turn(rows: Iterator[Row], capacity: int) -> Iterator[tuple]:
    """The last pieces of GROUP * GROUP workers, largest first, each into the first bin with room."""
    used: list[int] = []
    low: dict[int, int] = {}  # for each length the first bin that may have room
    for row in rows:
        n = row[3]
        b = low.get(n, 0)
        while b < len(used) and used[b] + n > capacity:
            b += 1
        low[n] = b
        if b == len(used):
            used.append(0)
        yield row, ((1 << 62) | (row[1] // (GROUP * GROUP) << 32)) + b, used[b]
        used[b] += n


def pack_bytes(df: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """``pack`` with ids as little-endian unsigned 32-bit integers in a binary.

    The later rounds move lengths only; what they decide is joined with the pieces by number.
    """
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("t"))
    filled = store(texts.mapInArrow(lambda batches: _fill(batches, tokenizer, end, capacity), FILLED), "pieces")
    rest = filled.filter("sequence_id IS NULL").select("class", "worker", "piece", "length")
    group, all_groups = F.expr(f"worker div {GROUP}"), F.expr(f"worker div {GROUP * GROUP}")
    again = store(
        rest.repartition("class", group).sortWithinPartitions("class", group, "piece").mapInArrow(
            lambda batches: _rounds(batches, lambda r: (r[0], r[1] // GROUP), lambda rows: _by_class(rows, capacity)), SHORT_ROWS),
        "pieces-by-class")
    rest = again.filter("sequence_id IS NULL").select("class", "worker", "piece", "length")
    last = rest.repartition(all_groups).sortWithinPartitions(all_groups, F.col("length").desc(), "piece").mapInArrow(
        lambda batches: _rounds(batches, lambda r: (r[1] // (GROUP * GROUP),), lambda rows: _in_turn(rows, capacity)), SHORT_ROWS)
    decided = again.filter("sequence_id IS NOT NULL").unionByName(last).select("piece", "sequence_id", "offset")
    columns = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
    open_ = filled.filter("sequence_id IS NULL").drop("sequence_id", "offset").join(decided, "piece")
    return filled.filter("sequence_id IS NOT NULL").select(columns).unionByName(open_.select(columns))


def pack(df: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """Pieces (PIECES) with their ``sequence_id`` and ``offset``; each id of every document lies in exactly one piece."""
    packed = pack_bytes(df, tokenizer, end, capacity, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = id_lists(batch.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays([lists if c == "ids" else batch.column(c) for c in batch.schema.names], names=batch.schema.names)

    return packed.mapInArrow(run, f"{PIECES}, {PLACED}")


def sequences(pieces: DataFrame, pad: int, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids, n_tokens): the sequences in full, padded with ``pad`` to ``capacity`` except at a power of two."""
    joined = pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    power = n.bitwiseAND(n - 1) == 0
    padded = F.when(power, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad), F.lit(capacity) - n)))
    return joined.select("sequence_id", padded.alias("ids"), n.cast("long").alias("n_tokens"))
