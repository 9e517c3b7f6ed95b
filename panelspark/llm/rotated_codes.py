"""Nearest neighbours by cosine over randomly rotated one-bit codes.

Vectors are scaled to length one and rotated by a fixed random orthogonal matrix; the signs of the coordinates, packed to
bits, are the code. With x' the rotated vector and s its signs over sqrt(D), a query's inner product with x is estimated as
<s, q'> / <s, x'>, off by at most ERRORS * sqrt((1 - <s, x'>^2) / <s, x'>^2 / (D - 1)) with high probability; the code,
<s, x'> and that bound are stored next to the vector. A candidate is reranked with the vectors themselves in double
precision if its upper bound reaches the k-th largest lower bound. Every row is indexed; nothing is fitted to data.

The queries meet all rows in blocks: rows are dealt to cells of about ROWS, queries to blocks of about QUERIES, and each
(block, cell) is one group that returns its k nearest; the k nearest of those are the answer. Work and shuffle are those of
the stated query set against all rows. No task holds more than one block of either side.

Rows with a null vec_id, and vectors that are null, empty, zero or hold null or non-finite components, take no part;
vectors of different lengths are never compared. Of rows that repeat a vec_id the one with the least
vector takes part. Ties go to the smaller vec_id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import store

ROWS = 8192
QUERIES = 512
ERRORS = 1.9
SEED = 11
FOUND = "query_id long, vec_id long, score double"


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, <s, x'> and error bounds of the rows."""
    dim = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(dim)
    aligned = np.maximum(np.abs(turned).sum(axis=1) / np.sqrt(dim), 1e-9)
    bound = ERRORS * np.sqrt(np.maximum(1 - aligned**2, 0) / aligned**2 / max(dim - 1, 1)) + 1e-6
    return np.packbits(turned >= 0, axis=1), aligned, bound


def cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in double precision; equal vectors give equal values wherever they stand."""
    dot = np.einsum("ij,ij->i", queries, rows)
    return dot / (np.sqrt(np.einsum("ij,ij->i", queries, queries)) * np.sqrt(np.einsum("ij,ij->i", rows, rows)))


def _matrix(column: pd.Series, kind=np.float64) -> np.ndarray:
    return np.stack([np.asarray(v, kind) for v in column])


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of each query of one block in one cell."""
    found = []
    for dim in sorted(set(queries["dim"]) & set(rows["dim"])):
        q, r = queries[queries["dim"] == dim], rows[rows["dim"] == dim]
        qv, rv = _matrix(q["v"]), _matrix(r["v"])
        qid, rid = q["id"].to_numpy(), r["id"].to_numpy()
        signs = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in r["code"]]), axis=1, count=dim).astype(np.float32) * 2 - 1
        unit = qv / np.linalg.norm(qv, axis=1, keepdims=True)
        aligned, bound = r["aligned"].to_numpy(), r["bound"].to_numpy()
        estimate = (unit @ rotation(dim)).astype(np.float32) @ signs.T / np.float32(np.sqrt(dim)) / aligned.astype(np.float32)
        estimate[qid[:, None] == rid[None, :]] = -np.inf
        low = estimate - bound.astype(np.float32)
        kth = np.partition(low, -k, axis=1)[:, -k] if len(rid) > k else np.full(len(qid), -np.inf, np.float32)
        for i in range(len(qid)):
            near = np.flatnonzero((estimate[i] + bound >= kth[i]) & (estimate[i] > -np.inf))
            score = cosines(np.broadcast_to(qv[i], (len(near), dim)), rv[near])
            best = np.lexsort((rid[near], -score))[:k]
            found.append(pd.DataFrame({"query_id": qid[i], "vec_id": rid[near][best], "score": score[best]}))
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def index(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, dim, v, code, aligned, bound) of every row that takes part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    ok = F.forall(F.col("v"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(
        F.col("v"), lambda x: F.coalesce(x != 0, F.lit(False)))
    valid = df.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & ok)
    valid = valid.groupBy("id").agg(F.min("v").alias("v"))

    def add(frames):
        for frame in frames:
            if not len(frame):
                continue
            dims = frame["v"].map(len)
            for dim in sorted(set(dims)):
                part = frame[dims == dim].copy()
                code, aligned, bound = encode(_matrix(part["v"]))
                part["dim"], part["code"] = dim, [c.tobytes() for c in code]
                part["aligned"], part["bound"] = aligned, bound
                yield part[["id", "dim", "v", "code", "aligned", "bound"]]

    return valid.mapInPandas(add, "id long, dim int, v array<double>, code binary, aligned double, bound double")


def search(df: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row for which ``is_query`` (over column ``id``) holds."""
    rows = store(index(df, vector, key), "codes")
    queries = rows.filter(is_query)
    cells, blocks = -(-rows.count() // ROWS), -(-queries.count() // QUERIES)
    if not cells or not blocks:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    deal = F.xxhash64("id", "v")
    right = rows.withColumn("cell", F.pmod(deal, F.lit(cells)).cast("int")).withColumn("block", every(blocks))
    left = queries.select("id", "dim", "v", F.pmod(deal, F.lit(blocks)).cast("int").alias("block")).withColumn("cell", every(cells))
    near = left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell")).applyInPandas(
        lambda q, r: _nearest(q, r, k), FOUND)
    ranked = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("far"), F.col("vec_id"), F.col("score")))), 1, k).alias("near"))
    return ranked.select("query_id", F.posexplode("near").alias("rank", "n")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))
