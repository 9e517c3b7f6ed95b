"""Nearest-neighbour mutual information against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import information as I
from panelspark.operators import order as O


def psi(n):
    return sum(1 / i for i in range(1, int(n))) - 0.5772156649015329


def plain(x, y, k):
    used = ~np.isnan(x)
    x, y = x[used], y[used]
    used = np.array([(y == c).sum() > 1 for c in y], bool)
    x, y = x[used], y[used]
    if not len(x):
        return None
    total = 0.0
    for i in range(len(x)):
        own = np.sort(np.abs(np.delete(x[y == y[i]], np.flatnonzero(np.flatnonzero(y == y[i]) == i)) - x[i]))
        kc = min(k, len(own))
        r = own[kc - 1]
        d = np.abs(x - x[i])
        m = ((d < r) | (d == 0)).sum()
        total += psi(kc) - psi(len(own) + 1) - psi(m)
    return max(psi(len(x)) + total / len(x), 0.0)


@pytest.mark.parametrize("block", [I.BLOCK, 7])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(I, "BLOCK", block)
    rng = np.random.default_rng(1)
    y = rng.integers(-1, 2, 150)
    x = np.stack([rng.normal(size=150) + y, rng.normal(size=150).round(1), rng.integers(0, 3, 150).astype(float) * y, np.full(150, np.nan),
                  np.where(rng.random(150) < 0.3, np.nan, (rng.normal(size=150) * 1e-3).round(4)), np.where(np.arange(150) == 5, 1.0, np.nan),
                  np.where(rng.random(150) < 0.5, -0.0, 0.0)], 1)
    y = np.append(y, 7)
    x = np.vstack([x, np.ones(x.shape[1])])  # a class of one row
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(int(c), *(None if math.isnan(v) and i % 2 else float(v) for v in r)) for i, (c, r) in enumerate(zip(y, x))] + [(None, *[1.0] * len(names))]
    df = spark.createDataFrame(rows, "reod int, " + ", ".join(f"{c} double" for c in names))
    got = {r["feature"]: r["score"] for r in I.nearest_information(df, names).collect()}
    for i, c in enumerate(names):
        want = plain(x[:, i], y, 3)
        assert got[c] is None if want is None else got[c] == pytest.approx(want, abs=1e-9), c
    assert I.nearest_information(df.limit(0), names).where("score IS NOT NULL").count() == 0


def test_bounds_are_the_last_doubles_within():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=200) * 10.0 ** rng.integers(-8, 8, 200), [0.0, -1.0, 1.0, 5e-324, -1e300]])
    r = np.concatenate([np.abs(rng.normal(size=200)) * 10.0 ** rng.integers(-8, 8, 200), [0.0, 1.0, 1.0, 5e-324, 1e299]])
    lo, hi = I.reach(x, r)
    for sign, edge in ((1, hi), (-1, lo)):
        inside, outside = sign * (edge - x), sign * (np.nextafter(edge, sign * np.inf) - x)
        assert ((inside < r) | (edge == x)).all()
        assert ((outside >= r) | (r == 0)).all()


def test_digamma(spark):
    rows = spark.range(1, 200).select("id", I.digamma(F.col("id")).alias("v")).collect()
    assert all(r["v"] == pytest.approx(psi(r["id"]), abs=1e-11) for r in rows)


def test_places_and_sums(spark):
    rng = np.random.default_rng(4)
    rows = [(None if k == 3 else int(k), None if v == 0 else float(v), int(w), i) for i, (k, v, w) in enumerate(zip(
        np.where(rng.random(300) < 0.5, 1, rng.integers(0, 4, 300)), rng.integers(0, 40, 300), rng.integers(0, 5, 300)))]
    df = spark.createDataFrame(rows, "k int, AT double, w long, first int").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[3]))
    rank, before, seen = {}, {}, {}
    for k, _, w, i in ordered:
        n, s = seen.get(k, (0, 0))
        rank[i], before[i], seen[k] = n, s, (n + 1, s + w)
    got = {r["first"]: (r["rank"], r["total"]) for r in O.rank_within(df, ["k"], ["AT", "first"]).collect()}
    assert got == {i: (rank[i], seen[k][0]) for k, _, _, i in rows}
    assert {r["first"]: r["before"] for r in O.sum_before(df, ["k"], ["AT", "first"], "w").collect()} == before
    assert sorted(r["rank"] for r in O.rank_within(df, [], ["first"]).collect()) == list(range(300))
    assert O.rank_within(df.limit(0), ["k"], ["AT"]).count() == 0
