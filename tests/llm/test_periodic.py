"""Runs of repeated words against listing every lag."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import periodic, queries
from panelspark.llm.common import table
from tests.llm import helpers as H


def plain(w, shortest=12):
    found, ids = [], np.unique(np.array(w, object), return_inverse=True)[1]
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]])
        for i, j in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            part = ids[i:j + q]
            if len(part) >= max(shortest, 2 * q) and not any((part[p:] == part[:-p]).all() for p in range(1, q)):
                found.append((i, len(part), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made(rng):
    kinds = rng.choice([1, 2, 2, 3, 5, 30])
    w = [str(rng.randrange(kinds)) for _ in range(rng.randrange(90))]
    if w and rng.random() < 0.6:
        a = rng.randrange(len(w))
        p = 1 + (len(w) - a) // rng.randrange(2, 9)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))] + [str(rng.randrange(kinds)) for _ in range(rng.randrange(20))]
    return w


def test_runs_equal_every_lag():
    rng, n = random.Random(3), 0
    for _ in range(150):
        texts = [made(rng) for _ in range(4)]
        got = periodic.find([[x.encode() for x in w] for w in texts])
        assert got == [plain(w) for w in texts]
        n += sum(map(len, got))
    assert n > 300


def test_long_repeats_take_little_work():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic.find([[b"x"] * 100_000]) == [[(0, 100_000, 1)]]
    assert periodic.find([b]) == [plain(b)]


def test_edge_cases(spark):
    run = " ".join("ab cd ef".split() * 6)
    texts = [None, "", " \n\t", run, run, "x " * 11, "x " * 12, "x" * 200_000, f"one {run}\n two\x0b{run}", "日本 語 " * 9, "\x85a \x1c " * 9]
    df = H.documents(spark, texts, [0, 1, 2, 3, 3, 4, 5, 6, 7, 8, None]).withColumns(
        {"RUNS": F.lit(1), "n_words": F.lit("y"), "runs_of": F.lit(2)})
    found = periodic.periodic_runs(df)
    assert found.columns == [*df.columns, "_runs", "collapsed", "_n_words"]
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = H.words(r["text"])
        assert [tuple(x) for x in r["_runs"]] == plain(w) and r["_n_words"] == len(w) and r["collapsed"] == collapsed(w, plain(w))
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    assert not any(r["_runs"] for r in periodic.periodic_runs(df.filter("doc_id = 4")).collect())


def test_query_equals_plain_version(spark):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, H.FOLDER).collect()}
    docs = table(spark, H.FOLDER, "documents").collect()
    assert len(got) == len(docs)
    seen = 0
    for d in docs:
        w = H.words(d["text"])
        n, h = len(w), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs, r = plain(w), got[d["doc_id"]]
        seen += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"], r["n_runs"]) == (*best, len(runs))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert seen > 10
