"""Three-phase top-k search against all pairs."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import queries, topk
from panelspark.llm.common import table
from tests.llm import helpers as H
from tools.check import compare

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, k, every):
    used = []
    for i, (key, v, *_) in enumerate(rows):
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        most = math.isqrt((1 << 62) // max(len(v), 1))
        used.append((i, key, [max(-most, min(most, math.floor(256 * float(np.float32(x))))) for x in v]))
    found = []
    for i, key, q in used:
        if key % every == 0:
            near = sorted((-sum(a * b for a, b in zip(q, v)), other, j) for j, other, v in used if j != i and len(v) == len(q))
            found += [(key, rank + 1, other, -s) for rank, (s, other, _) in enumerate(near[:k])]
    return sorted(found)


def check(spark, rows, k=5, every=3):
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.search(df, F.expr(f"id % {every} = 0"), k).collect()
    assert sorted(map(tuple, got)) == plain(rows, k, every)


@pytest.mark.parametrize("cell", [8192, 7])
def test_search_equals_all_pairs(spark, cell, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", cell)
    rng = random.Random(cell)
    rows = [(i, [rng.gauss(0, 1) for _ in range(9)], 0) for i in range(40)]
    rows += [(100 + i, rows[3][1], 0) for i in range(20)]  # copies, ties by id
    rows += [(i, [float(rng.randrange(-1, 2)) for _ in range(4)], 0) for i in range(200, 230)]
    rows += [(3, rows[3][1], 0), (3, rows[5][1], 0), (300, [], 0), (301, [], 0), (303, [], 0), (333, [1.0] * 3, 0)]
    check(spark, rows)


def test_odd_vectors(spark):
    rows = [(None, [1.0], 0), (0, None, 0), (3, [None, 1.0], 0), (6, [float("nan"), 1.0], 0), (9, [float("inf"), 1.0], 0),
            (12, [0.0, 0.0], 0), (15, [-1.0, -2.0], 0), (16, [1e30, -1e30], 0), (18, [1e30, 3.0], 0), (21, [4000.7, -0.001], 0), (24, [-300.0, 1e5], 0)]
    check(spark, rows, k=3)
    check(spark, [(0, [1.0], 0)])
    check(spark, rows[:5])
    df = spark.createDataFrame(rows, VECTORS).withColumnsRenamed({"label": "ROW"}).withColumns({"e": F.lit(1), "id": F.lit("x"), "q": F.lit(2)})
    assert topk.search(df, F.expr("id % 3 = 0")).count() == len(plain(rows, 5, 3))
    assert topk.search(df.limit(0), F.expr("id % 3 = 0")).count() == 0


def test_query_equals_sql_and_all_pairs(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{H.FOLDER}/embeddings.parquet'")
    df = queries.op12_top_k_search(spark, H.FOLDER)
    assert compare(df, con, queries.ORACLES["op12_top_k_search"]) is None
    assert sorted(map(tuple, df.collect())) == plain([tuple(r) for r in table(spark, H.FOLDER, "embeddings").collect()], 5, 50)
