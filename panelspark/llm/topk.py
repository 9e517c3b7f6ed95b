"""Exact top-k search by inner product in three phases with one uniform threshold.

Vectors are turned into whole numbers, floor(scale * component). The components are dealt to SLICES slices and the vectors to cells,
so a node (slice, cell) knows the local scores of its vectors, and a score is the sum of one local score a slice.

1. Each node returns a list of the best local scores of every query, and its least one. The least of all nodes of a slice
   is taken off its local scores, so none is negative. The nodes are asked for the other local scores of the listed vectors;
   their k-th largest sum is a bound that k vectors reach.
2. A vector that reaches the bound has a local score of bound / SLICES or more somewhere. That cutoff goes to the nodes, and they
   return all local scores that reach it. With these the bound may rise, and a vector whose sum, with
   the most that the cutoff leaves for unreported slices, stays under it is out.
3. The nodes are asked for the scores still missing of the vectors left, and the k largest sums are the answer.

Equal vectors are one entry with their k smallest ids, equal queries one query; a query's own row is left out at
the end, from one result more than asked for. Nodes hold at most ROWS entries; questions stream past them.

Rows with a null id, and vectors that are null or hold null or non-finite components, take no part; only vectors of the same length are
compared, empty ones with score 0. Components are held within floor(sqrt(2^62 / length)), 2^28 for 64, so that scores stay exact
whole numbers. Rows that repeat an id are queries and candidates of their own. Ties go to the smaller id. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import store

SLICES = 2
ROWS = 8192
LISTED = 32  # local scores that a node lists in the first phase, k at least
ASKED = 256  # questions answered together
SALTS = 8  # tasks that the rows of one query vector are dealt to
RESULT = "query_id long, rank int, vec_id long, score long"
LOCAL = "q long, slice int, e long, s long, least long"


def whole_numbers(vector: np.ndarray, scale: float = 256.0) -> np.ndarray:
    most = math.isqrt((1 << 62) // max(len(vector), 1))
    return np.clip(np.floor(scale * vector), -most, most).astype(np.int64)


def pack(numbers: np.ndarray) -> bytes:
    """Little-endian integers of the least of 2, 4 or 8 bytes that holds all."""
    most = int(np.abs(numbers).max(initial=0))
    return numbers.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    if dim == 0:
        return np.zeros((len(packed), 0), np.int64)
    widths = np.array([len(p) // dim for p in packed])
    out = np.empty((len(packed), dim), np.int64)
    for w in (2, 4, 8):
        if (widths == w).any():
            out[widths == w] = np.frombuffer(b"".join(p for p in packed if len(p) == w * dim), f"<i{w}").reshape(-1, dim)
    return out


def inner(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact inner products, in the fastest kind of number that holds them."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(entries).max(initial=0)) * queries.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (queries.astype(kind) @ entries.T.astype(kind)).astype(np.int64)


def _integers(df: DataFrame, vector: str, key: str, scale: float) -> DataFrame:
    """(row, id, dim, v) of every row that takes part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(F.col("x"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    valid = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), v.alias("x")).filter(
        F.col("id").isNotNull() & finite)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(x, float) for x in batch.column("x").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("id"), pa.array([len(x) for x in vectors], pa.int32()),
                pa.array([pack(whole_numbers(x, scale)) for x in vectors], pa.binary())], names=["row", "id", "dim", "v"])

    return store(valid.mapInArrow(run, "row long, id long, dim int, v binary"), "integer-vectors")


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(e, dim, v, members): distinct vectors, each with its k smallest (id, row)."""
    place = F.row_number().over(Window.partitionBy("dim", "v").orderBy("id", "row"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k)
    return few.groupBy("dim", "v").agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("members"), F.min("row").alias("e"))


def _part(dim: int, slice_: int) -> slice:
    return slice(dim * slice_ // SLICES, dim * (slice_ + 1) // SLICES)


Answer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list], Iterator[tuple]]


def _nodes(entries: DataFrame, asked: DataFrame, cells: int, answer: Answer) -> DataFrame:
    """Answers (LOCAL) of every node to the questions (q, dim, v, more) of its length; ``more`` is an array of longs.

    Each (dim, slice, cell) is a run of sorted rows: its entries, which are held, then the questions, which stream. A question
    with ``cell`` goes to that cell only, one with ``slice`` to that slice only.
    """
    def everywhere(df: DataFrame, column: str, n: int) -> DataFrame:
        return df if column in df.columns else df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    held = everywhere(entries.select("dim", "cell", F.lit(0).alias("kind"), F.col("e").alias("n"), "v", F.array().cast("array<bigint>").alias("more")), "slice", SLICES)
    come = everywhere(everywhere(asked.withColumns({"kind": F.lit(1), "n": F.col("q")}), "cell", cells), "slice", SLICES)
    columns = ["dim", "slice", "cell", "kind", "n", "v", "more"]
    node = ["dim", "slice", "cell"]
    dealt = held.select(columns).unionByName(come.select(columns)).repartition(*node).sortWithinPartitions(*node, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, kept, ids, matrix = None, [], [], None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*node, "kind"))))
            begun = 0
            while begun < len(keys):
                end = begun
                while end < len(keys) and keys[end] == keys[begun] and end - begun < ASKED:
                    end += 1
                (dim, part, cell, kind), rows = keys[begun], batch.slice(begun, end - begun)
                if (dim, part, cell) != now:
                    now, names, kept, ids, matrix = (dim, part, cell), [], [], None, None
                numbers = unpack(rows.column("v").to_pylist(), dim)[:, _part(dim, part)]
                if kind == 0:
                    names.append(rows.column("n").to_numpy())
                    kept.append(numbers)
                elif kept:
                    if matrix is None:
                        matrix, ids = np.concatenate(kept), np.concatenate(names)
                    for q, e, s, least in answer(rows.column("n").to_numpy(), numbers, ids, matrix, rows.column("more").to_pylist()):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(q, pa.int64()), pa.array([part] * len(q), pa.int32()), *(pa.array(x, pa.int64()) for x in (e, s, least))],
                            names=["q", "slice", "e", "s", "least"])
                begun = end

    return dealt.mapInArrow(run, LOCAL)


def _cell(cells: int) -> Column:
    return F.pmod(F.xxhash64("e"), F.lit(cells)).cast("int")


def _best(k: int) -> Answer:
    """Phase 1: the k largest local scores of each question and its least."""
    def answer(q, asked, e, held, more):
        scores = inner(asked, held)
        n = min(k, len(e))
        top = np.argpartition(scores, len(e) - n, axis=1)[:, len(e) - n:]
        yield np.repeat(q, n), e[top].ravel(), np.take_along_axis(scores, top, 1).ravel(), np.repeat(scores.min(axis=1), n)

    return answer


def _reaching(q, asked, e, held, more):
    """Phase 2: the local scores, over the least one, that reach the cutoff; ``more`` holds cutoff and least score."""
    cutoff, least = np.array(more, np.int64).reshape(len(q), 2).T
    scores = inner(asked, held) - least[:, None]
    i, j = np.nonzero(scores >= cutoff[:, None])
    yield q[i], e[j], scores[i, j], least[i]


def _named(q, asked, e, held, more):
    """The local scores of the entries that ``more`` names, over the least one, its first number."""
    order = np.argsort(e)
    wanted = [np.array(m[1:], np.int64) for m in more]
    least = np.repeat(np.array([m[0] for m in more], np.int64), [len(w) for w in wanted])
    i, flat = np.repeat(np.arange(len(q)), [len(w) for w in wanted]), np.concatenate(wanted)
    j = order[np.searchsorted(e, flat, sorter=order)]
    scores = np.einsum("ij,ij->i", asked[i], held[j]) - least
    yield q[i], e[j], scores, least


def _kth(sums: DataFrame, k: int) -> DataFrame:
    """(q, bound): the k-th largest ``low`` of every query, 0 if there are fewer."""
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("low").desc()))
    few = sums.withColumn("place", place).filter(F.col("place") <= k)
    return few.groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.min("low")).otherwise(0).alias("bound"))


def _three_phases(entries: DataFrame, queries: DataFrame, cells: int, k: int) -> DataFrame:
    """(q, e, score) of the k best entries, and maybe more, of each query (q, dim, v)."""
    none = F.array().cast("array<bigint>")
    first = store(_nodes(entries, queries.withColumn("more", none), cells, _best(max(k, LISTED))), "local-best")
    floors = store(first.groupBy("q", "slice").agg(F.min("least").alias("floor")), "least-scores")
    listed = _sums(first.join(floors, ["q", "slice"]).withColumn("s", F.col("s") - F.col("floor")))
    # Whole numbers: a local score reaches bound / SLICES where it reaches the next whole number.
    bounds = _kth(_resolved(entries, queries, floors, listed, cells), k).withColumn("cutoff", F.expr(f"(bound + {SLICES - 1}) div {SLICES}"))
    bounds = store(bounds, "bounds")

    asked = queries.join(bounds, "q").join(floors, "q").select("q", "dim", "v", "slice", F.array("cutoff", "floor").alias("more"))
    second = _sums(store(_nodes(entries, asked, cells, _reaching), "local-reaching"))
    better = bounds.join(_kth(second, k).withColumnRenamed("bound", "higher"), "q", "left")
    most = F.col("low") + (SLICES - F.size("seen")) * F.greatest(F.col("cutoff") - 1, F.lit(0))
    left = second.join(better, "q").filter(most >= F.greatest("bound", "higher")).select("q", "e", "low", "seen")
    total = _resolved(entries, queries, floors, store(left, "candidates"), cells)
    taken = floors.groupBy("q").agg(F.sum("floor").alias("floor"))
    return total.join(taken, "q").select("q", "e", (F.col("low") + F.col("floor")).alias("score"))


def _sums(local: DataFrame) -> DataFrame:
    """(q, e, low, seen): sum of the local scores known of each pair, and their slices."""
    return store(local.groupBy("q", "e").agg(F.sum("s").alias("low"), F.collect_set("slice").alias("seen")), "partial-sums")


def _resolved(entries: DataFrame, queries: DataFrame, floors: DataFrame, sums: DataFrame, cells: int) -> DataFrame:
    """(q, e, low) of ``sums`` in full: the nodes are asked for what is missing."""
    open_slices = F.explode(F.array_except(F.sequence(F.lit(0), F.lit(SLICES - 1)), F.col("seen")))
    missing = sums.filter(F.size("seen") < SLICES).select("q", "e", open_slices.alias("slice"))
    # A question names entries of one cell, so at most as many as a cell holds.
    named = missing.groupBy("q", "slice", _cell(cells).alias("cell")).agg(F.collect_list("e").alias("wanted"))
    asked = named.join(floors, ["q", "slice"]).join(queries, "q").select(
        "q", "dim", "v", "slice", "cell", F.concat(F.array("floor"), F.col("wanted")).alias("more"))
    rest = _nodes(entries, asked, cells, _named).select("q", "e", F.col("s").alias("low"))
    return sums.select("q", "e", "low").unionByName(rest).groupBy("q", "e").agg(F.sum("low").alias("low"))


def search(df: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", key: str = "vec_id", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each row for which ``is_query`` (over column ``id``) holds."""
    rows = _integers(df, vector, key, scale)
    entries = _entries(rows, k + 1)
    cells = max(1, -(-rows.count() // ROWS))
    entries = store(entries.withColumn("cell", _cell(cells)), "entries")
    asking = rows.filter(is_query)
    queries = store(asking.groupBy("dim", "v").agg(F.min("row").alias("q")), "queries")

    scored = _three_phases(entries.select("e", "dim", "v", "cell"), queries, cells, k + 1)
    listed = scored.join(entries.select("e", "members"), "e").select("q", "score", F.explode("members").alias("m")).select(
        "q", "score", F.col("m.id").alias("id"), F.col("m.row").alias("row"))
    best = [F.col("score").desc(), F.col("id"), F.col("row")]
    few = listed.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(*best))).filter(F.col("place") <= k + 1)
    found = few.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "id", "row", "score"))).alias("found"))

    answers = found.join(queries, "q").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("q")
    dealt = asking.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    own = dealt.join(answers, ["dim", "v", "salt"]).select(
        F.col("id").alias("query_id"), F.slice(F.filter("found", lambda x: x["row"] != F.col("row")), 1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("rank", "n")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.score").alias("score"))
