"""Byte-level BPE by rank files, with a segment tree over byte positions.

Each leaf holds the rank of the pair that starts at its position, with the position below it, so the root is the
leftmost pair of least rank. A merge sets three leaves, each in logarithmic steps: the pair that begins at the merged
part, the one before it, and the one that is gone. A piece of n bytes costs n log n, whatever it looks like.

Null text counts as empty: no ids, decoded to nothing. Repeated rows are encoded one by one, an empty table gives an
empty result, other columns are kept as they are.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelspark.llm.common import free_name, text_of
from panelspark.llm.wordtokens import id_lists

CACHED = 700_000  # pieces that a worker keeps
LONGEST = 64  # characters of a piece that is kept
_NONE = 1 << 62


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the leftmost pair of least rank is merged until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << 32 | i
    for at in range(width - 1, 0, -1):
        a, b = tree[2 * at], tree[2 * at + 1]
        tree[at] = a if a < b else b
    after = list(range(1, n + 2))  # start of the part behind the one that starts here
    before = list(range(-1, n))
    while n > 1 and tree[1] < _NONE:
        i = tree[1] & 0xFFFFFFFF
        gone = after[i]
        behind = after[gone]
        after[i] = behind
        before[behind] = i
        updates = [(gone, _NONE)] if gone < n - 1 else []
        rank = ranks.get(piece[i:after[behind]]) if behind < n else None
        updates.append((i, _NONE if rank is None else rank << 32 | i))
        p = before[i]
        if p >= 0:
            rank = ranks.get(piece[p:behind])
            updates.append((p, _NONE if rank is None else rank << 32 | p))
        for leaf, value in updates:
            at = width + leaf
            tree[at] = value
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                least = a if a < b else b
                if tree[at] == least:
                    break
                tree[at] = least
                at >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:after[at]]])
        at = after[at]
    return ids


class Codec:
    """Ranks of a file (base64 token and rank a line) and the pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {b: a for a, b in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        kept = self.kept
        if len(kept) > CACHED:
            kept.clear()
        pieces = self.find(text)
        new = [p for p in set(pieces) if p not in kept]
        for piece in new:
            kept[piece] = array("I", merge(piece.encode(), self.ranks)).tobytes()
        out = b"".join([kept[p] for p in pieces])
        for piece in new:
            if len(piece) > LONGEST:
                del kept[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` with the ids of its texts (array of int), without special tokens; ``keep``: the columns to keep, default all."""
    name, held = free_name(df, ids), free_name(df, "_text")
    df = df.select(*(df.columns if keep is None else keep), text_of(text).alias(held))
    schema = T.StructType(list(df.schema.fields[:-1]) + [T.StructField(name, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            rows = [c.encode(t) for t in batch.column(held).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], id_lists(rows)], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for; null ids give null."""
    name = free_name(df, decoded)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            lists = batch.column(ids)
            ends = lists.offsets.to_pylist()
            flat = lists.values.to_numpy(zero_copy_only=False)
            valid = pc.is_valid(lists).to_pylist()
            out = [c.decode(flat[a:b].tolist()) if v else None for a, b, v in zip(ends[:-1], ends[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.fieldNames())

    return df.mapInArrow(run, schema)
