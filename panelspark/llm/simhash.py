"""SimHash near-duplicates through segment popcounts.

A fingerprint of 64 bits is cut into 32 segments; the bits set in each segment form a vector of small numbers. A
differing bit moves one of those numbers by one, so the Manhattan distance of two vectors never exceeds the
differing bits and serves as a lower bound. The 32 coordinates are dealt to ``d + 2`` blocks of a grid for links of
at most ``d`` bits: two vectors at distance d or less agree in two blocks at least, hence share one of the cells that
two blocks span. Inside a cell candidates must lie within distance d of each other in bits set, then in the vector,
and are verified on the bits.

Equal fingerprints are one class before all this, so a group of exact copies costs one row. Inside a cell links come
from a search that compares each newly reached fingerprint with those not reached yet and keeps the links that
reach one: a spanning forest of the exact link graph, never all pairs. A cell with more than BLOCK fingerprints is
cut into blocks, and each pair of blocks is a group of its own.

Null text counts as empty; a text without words has fingerprint zero, linked like any other. Rows with a null doc_id
take part; a class takes the least doc_id it has, null if it has none. Repeated rows come out as often as they went in.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from panelspark.llm.common import free_name, store, text_of
from panelspark.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 32
BLOCK = 2048
SMALL = 48  # groups up to this size are compared as a whole matrix


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of every shingle of ``size`` words, repeats included; of the whole sequence if it is shorter.

    Bytes fit the definition as they are: ``lower`` changes A-Z only and ``split`` cuts at U+0020 and U+0009 to U+000D.
    """
    w = text.lower().split()
    if len(w) >= size:
        return [xxh64_intdigest(b" ".join(x), 42) for x in zip(*(w[k:] for k in range(size)), strict=False)]
    return [xxh64_intdigest(b" ".join(w), 42)] if w else []


def majority_bits(flat: np.ndarray, length: np.ndarray) -> np.ndarray:
    """One unsigned 64-bit fingerprint a list: a bit is set if it is in over half of the list's values.

    ``flat`` holds the lists' values one after the other, ``length`` their sizes.
    """
    out = np.zeros(len(length), np.uint64)
    if not len(flat):
        return out
    end = np.cumsum(length)
    for lo, hi in _runs(end, 1 << 18):
        n = length[lo:hi]
        full = np.flatnonzero(n > 0)
        if not len(full):
            continue
        part = flat[end[lo] - length[lo]:end[hi - 1]]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (end[lo:hi] - n - (end[lo] - length[lo]))[full]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        packed = np.packbits(2 * sums > n[full][:, None], axis=1, bitorder="little")
        out[lo + full] = packed.view(np.uint64)[:, 0]
    return out


def _runs(end: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of lists with about ``most`` values together, one list at least."""
    lo, done = 0, 0
    while lo < len(end):
        hi = max(lo + 1, int(np.searchsorted(end, done + most, "right")))
        yield lo, hi
        lo, done = hi, int(end[hi - 1])


def fingerprints(df: DataFrame, text: str = "text", size: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, fp), or other columns than doc_id, with the fingerprint as a signed long."""
    def majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(shingle_hashes(t, size), np.uint64) for t in batch.column("t").cast(pa.binary()).to_pylist()]
            flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
            fp = majority_bits(flat, np.array([len(x) for x in lists], np.int64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fp)], [*keep, "fp"])

    texts = df.select(*keep, text_of(text).alias("t"))
    return texts.mapInArrow(majority, texts.select(*keep, F.lit(0).cast("long").alias("fp")).schema)


def _cells(max_bits: int) -> list[int]:
    """For each pair of blocks, a mask over the fingerprint that leaves those blocks' segments."""
    width = 64 // SEGMENTS
    blocks = np.array_split(np.arange(SEGMENTS), max_bits + 2)
    one = [sum(((1 << width) - 1) << (width * int(s)) for s in b) for b in blocks]
    return [one[i] | one[j] for i, j in combinations(range(len(one)), 2)]


def segment_popcounts(fp: Column) -> Column:
    """The embedding packed into one long: two-bit segments hold 0, 1 or 2, their number of set bits."""
    low = F.lit(0x5555555555555555).cast("long")
    upper = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseXOR(upper).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(upper).bitwiseAND(low), 1))


_LOW = np.uint64(0x5555555555555555)


def _embedding(fp: np.ndarray) -> np.ndarray:
    return (fp & _LOW) + ((fp >> np.uint64(1)) & _LOW)


def _within(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Matrix of links between fingerprints a and b: the lower bounds first, then the bits of what is left."""
    pa_, pb = np.bitwise_count(a).astype(np.int16), np.bitwise_count(b).astype(np.int16)
    near = np.abs(pa_[:, None] - pb[None, :]) <= bits
    i, j = np.nonzero(near)
    ea, eb = _embedding(a)[i], _embedding(b)[j]
    # Manhattan distance of two-bit counters: per counter |x - y|, from x xor y and the case 0 against 2.
    x = ea ^ eb
    lone = x & _LOW
    both = (x >> np.uint64(1)) & _LOW & ~lone
    ok = np.bitwise_count(lone).astype(np.int16) + 2 * np.bitwise_count(both).astype(np.int16) <= bits
    i, j = i[ok], j[ok]
    ok = np.bitwise_count(a[i] ^ b[j]) <= bits
    links = np.zeros((len(a), len(b)), bool)
    links[i[ok], j[ok]] = True
    return links


def _forest(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of one group: breadth first, newly reached against not yet reached."""
    left = np.arange(len(fp))
    frontier = left[:0]
    a, b = [], []
    while len(left):
        if not len(frontier):
            frontier, left = left[:1], left[1:]
            continue
        at, frontier = frontier[:SMALL], frontier[SMALL:]
        links = _within(fp[at], fp[left], bits)
        hit = links.any(axis=0)
        if hit.any():
            a.append(fp[left[hit]])
            b.append(fp[at[links[:, hit].argmax(axis=0)]])
            frontier = np.concatenate([frontier, left[hit]])
            left = left[~hit]
    empty = fp[:0]
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _pairs_of_small(fp: np.ndarray, start: np.ndarray, size: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All verified pairs of many small groups at once, by the distance of two rows inside their group."""
    a, b = [], []
    place = np.arange(len(fp)) - np.repeat(start, size)
    length = np.repeat(size, size)
    for step in range(1, int(size.max(initial=1))):
        i = np.flatnonzero(place + step < length)
        x, y = fp[i], fp[i + step]
        ok = np.abs(np.bitwise_count(x).astype(np.int16) - np.bitwise_count(y)) <= bits
        x, y = x[ok], y[ok]
        ok = np.bitwise_count(x ^ y) <= bits
        a.append(x[ok])
        b.append(y[ok])
    empty = fp[:0]
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _links_of_groups(frames: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by group; a group that a batch cuts is carried on to the next."""
    def solve(key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        size = np.diff(np.r_[start, len(fp)])
        few = size <= SMALL
        inside = np.repeat(few, size)
        some = np.cumsum(size[few]) - size[few]
        parts = [_pairs_of_small(fp[inside], some, size[few], bits)]
        parts += [_forest(np.unique(fp[s:s + n]), bits) for s, n in zip(start[~few], size[~few])]
        a, b = (np.concatenate(x) for x in zip(*parts))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) < 50_000:
            continue
        rows = pd.concat(held, ignore_index=True)
        key = rows[["cell", "x", "lo", "hi"]].to_numpy()
        cut = int(np.flatnonzero((key != key[-1]).any(axis=1))[-1]) + 1 if (key != key[-1]).any() else 0
        if cut:
            yield solve(key[:cut], rows["fp"].to_numpy()[:cut].view(np.uint64))
        held = [rows.iloc[cut:]]
    rows = pd.concat(held, ignore_index=True) if held else pd.DataFrame()
    if len(rows):
        yield solve(rows[["cell", "x", "lo", "hi"]].to_numpy(), rows["fp"].to_numpy().view(np.uint64))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between different fingerprints ``fp`` that connect the same ones as all links of at most max_bits."""
    masks = _cells(max_bits)
    cells = distinct.select("fp", segment_popcounts(F.col("fp")).alias("e")).select(
        "fp", F.posexplode(F.array(*(F.col("e").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks))).alias("cell", "x"))
    cells = store(cells, "cells")
    large = store(
        cells.groupBy("cell", "x").count().filter(F.col("count") > BLOCK)
        .select("cell", "x", F.ceil(F.col("count") / BLOCK).cast("int").alias("k")), "large-cells")
    k = F.coalesce("k", F.lit(1))
    block = F.pmod(F.xxhash64("fp"), k).cast("int")
    dealt = (
        cells.join(large, ["cell", "x"], "left")
        .select("fp", "cell", "x", block.alias("i"), F.explode(F.sequence(F.lit(0), k - 1)).alias("j"))
        .select("fp", "cell", "x", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
        .repartition("cell", "x", "lo", "hi")
        .sortWithinPartitions("cell", "x", "lo", "hi")
    )
    return dealt.mapInPandas(lambda frames: _links_of_groups(frames, max_bits), "a long, b long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def classes(fingerprinted: DataFrame, max_bits: int = MAX_BITS, label: bool = False) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of (doc_id, fp); with ``label`` also one name a component of its own."""
    columns = ["fp", "component_id"] + ["label"] * label
    distinct = store(fingerprinted.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    reached = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    labelled = distinct.join(reached, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(least, "label").select(columns)


def near_duplicates(df: DataFrame, text: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the least doc_id reachable over links."""
    prints = store(fingerprints(df, text, size), "doc-fingerprints")
    return prints.join(store(classes(prints, max_bits), "classes"), "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, text: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, that of the least doc_id, with its columns. Rows of one doc_id in different groups are different
    documents: each group keeps its own; of several texts in a group under its least doc_id that of the least hash stays, and of equal rows
    one. Rows with a null doc_id can't be named, and all stay."""
    own, keep, kept_key = (free_name(df, c) for c in ("text_hash", "keep_id", "keep_hash"))
    hashed = df.withColumn(own, F.xxhash64(text_of(text)))
    prints = store(fingerprints(hashed, text, size, ("doc_id", own)), "doc-fingerprints")
    groups = store(classes(prints.select("doc_id", "fp"), max_bits, label=True), "classes")
    chosen = prints.filter("doc_id IS NOT NULL").join(groups, "fp").groupBy("label").agg(F.min(F.struct("doc_id", own)).alias("least")).select(
        F.col("least.doc_id").alias(keep), F.col(f"least.{own}").alias(kept_key))
    kept = hashed.join(chosen, (F.col("doc_id") == F.col(keep)) & (F.col(own) == F.col(kept_key)), "left_semi")
    return kept.dropDuplicates(["doc_id", own]).drop(own).unionByName(df.filter(F.col("doc_id").isNull()))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
