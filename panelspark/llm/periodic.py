"""Periodic runs of words by recursive frequency splitting and a lag scan.

Words are maximal runs of characters other than U+0020 and U+0009 to U+000D, numbered from 0. A run is a stretch of
consecutive words with smallest period q, at least max(SHORTEST, 2 * q) words long, that no neighbouring word extends with
that period. Every word of a run stands in it twice at least, its next copy q or fewer words away. So a word whose nearest
copy inside its segment is missing, or further away than half the segment, is in no run and splits the segment; the
parts are counted anew, until none splits any more. Parts under SHORTEST words hold no run. All documents of a batch
are split together, by sorting (segment, word) once a round, over the words still in play only.

The segments that stay are scanned lag by lag. A run of period q makes max(q, SHORTEST - q) or more consecutive matches
at lag q, and these cover a whole block of half that length wherever the blocks are laid; so only every block is
compared with the words q further on, by rolling hashes, n / q blocks a lag, and a block that agrees is extended word by
word. Stretches inside a run whose period divides the lag are its repetitions, not runs of their own.

Null text has no words, like an empty one; texts of any length are read whole, repeated rows and ids are independent rows, an
empty table gives an empty result, and all columns of the input stay (new ones get underscores in front of names taken).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import free_name, text_of

SHORTEST = 12
TOGETHER = 1 << 19  # words split together, unless one text has more
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash


def split(words: np.ndarray, segment: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Bounds of the parts of ``words`` (ids) that may hold runs; ``segment`` is the ascending text number of each word."""
    at = np.arange(len(words))
    segment = segment.astype(np.int64)
    while len(at):
        n = np.bincount(segment)[segment]
        order = np.lexsort((at, words[at], segment))
        same = (np.diff(segment[order]) == 0) & (np.diff(words[at[order]]) == 0)
        gap = np.where(same, np.diff(at[order]), len(words) + 1)
        nearest = np.empty(len(at), np.int64)
        nearest[order] = np.minimum(np.append(gap, len(words) + 1), np.insert(gap, 0, len(words) + 1))
        stays = (2 * nearest <= n) & (n >= shortest)
        if stays.all():
            break
        at, segment = at[stays], segment[stays]
        if len(at):
            begins = np.append(True, (np.diff(at) > 1) | (np.diff(segment) != 0))
            segment = np.cumsum(begins) - 1
    if not len(at):
        return []
    begins = np.flatnonzero(np.append(True, np.diff(segment) != 0))
    ends = np.append(begins[1:], len(at))
    return [(int(at[b]), int(at[e - 1]) + 1) for b, e in zip(begins, ends)]


def _reach(equal_to, limit: int) -> int:
    """How many of the first ``limit`` comparisons hold in a row; ``equal_to(a, b)`` gives those from a to b."""
    done, step = 0, 32
    while done < limit:
        found = equal_to(done, min(done + step, limit))
        if not found.all():
            return done + int(np.argmin(found))
        done, step = min(done + step, limit), step * 4
    return limit


def scan(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one segment."""
    n = len(words)
    powers = np.cumprod(np.insert(np.full(n, BASE), 0, np.uint64(1)))
    # sums[i] adds word j times BASE ** j up to i; shifting a block by q multiplies its sum by BASE ** q.
    sums = np.append(np.uint64(0), np.cumsum((words.astype(np.uint64) + np.uint64(1)) * powers[:n]))
    runs, wide = [], []
    for q in range(1, n // 2 + 1):
        least = max(q, shortest - q)
        half = (least + 1) // 2
        begins = np.arange(0, n - q - half + 1, half)
        block = sums[begins + half] - sums[begins]
        hits = begins[block * powers[q] == sums[begins + (half + q)] - sums[begins + q]]
        if not len(hits):
            continue
        wide = [r for r in wide if r[1] >= 2 * q]
        for start, length, period in wide:
            if q % period == 0 and len(hits):
                hits = hits[(hits < start) | (hits + half + q > start + length)]
        done = 0
        for hit in hits.tolist():
            if hit < done:
                continue
            right = _reach(lambda a, b: words[hit + a:hit + b] == words[hit + q + a:hit + q + b], n - q - hit)
            left = _reach(lambda a, b: (words[hit - b:hit - a] == words[hit + q - b:hit + q - a])[::-1], hit)
            done = hit + right
            start, length = hit - left, left + right + q
            if left + right < least or any(q % p == 0 and s <= start and start + length <= s + m for s, m, p in wide):
                continue
            runs.append((start, length, q))
            wide.append(runs[-1])
    return runs


def find(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start, then period."""
    flat = list(chain.from_iterable(texts))
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    words = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in split(words, np.repeat(np.arange(len(texts)), sizes), shortest):
        text = int(np.searchsorted(first, a, "right")) - 1
        found[text] += [(a - int(first[text]) + s, m, q) for s, m, q in scan(words[a:b], shortest)]
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, a blank between, without those that any run holds behind its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def _groups(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for text in texts:
        part.append(text.split())
        size += len(part[-1])
        if size >= TOGETHER:
            yield part
            part, size = [], 0
    if part:
        yield part


def periodic_runs(df: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """All columns with ``runs`` (start, length, period; by start, then period), ``collapsed`` text and ``n_words``."""
    own = free_name(df, "runs_of")
    names = [free_name(df, c) for c in ("runs", "collapsed", "n_words")]
    kinds = [T.ArrayType(RUN, False), T.StringType(), T.LongType()]
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, k) for c, k in zip(names, kinds))])
    columns = df.columns
    run_type = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begun = 0
            for part in _groups(batch.column(own).cast(pa.binary()).to_pylist()):
                runs = find(part, shortest)
                ends = np.cumsum([0, *map(len, runs)])
                flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_type))
                rows = batch.slice(begun, len(part))
                begun += len(part)
                yield pa.RecordBatch.from_arrays([
                    *(rows.column(c) for c in columns), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    pa.array([collapse(w, r).decode() for w, r in zip(part, runs)], pa.string()),
                    pa.array([len(w) for w in part], pa.int64())], names=schema.fieldNames())

    return df.withColumn(own, text_of(text)).mapInArrow(run, schema)
