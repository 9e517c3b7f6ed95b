"""Chained imputation against a plain loop over the columns."""

import numpy as np
import pytest

from panelspark.operators import chained as C
from panelspark.operators.iterative import _bayesian_ridge
from tests.data import collected, panel_frame, returns, to_spark


def plain(x, rounds, tolerance=1e-3):
    gaps = np.isnan(x)
    state = np.where(gaps, np.nan_to_num(np.nanmean(x, axis=0)), x)
    order = sorted((i for i in range(x.shape[1]) if gaps[:, i].any() and not gaps[:, i].all()), key=lambda i: (gaps[:, i].sum(), i))
    for _ in range(rounds):
        before = state.copy()
        for f in order:
            z = np.hstack([np.ones((len(state), 1)), state])
            z_seen = z[~gaps[:, f]]
            weights = _bayesian_ridge(z_seen.T @ z_seen, f)
            state[gaps[:, f], f] = z[gaps[:, f]] @ weights
        if np.abs(state - before).max() < tolerance * np.nanmax(np.abs(x)):
            break
    return state


@pytest.mark.parametrize("block", [1, 3, 5])
def test_equals_plain_loop(spark, block):
    frame = panel_frame(n=90, width=7, gaps=0.25, seed=4)
    frame.loc[:, "r3"] = frame["r0"] * 2 - frame["r1"] + 0.01 * frame["r2"]
    frame.loc[frame.index % 9 == 0, "r3"] = np.nan
    cols = returns(frame)
    raw = frame.sort_values("ID")[cols].to_numpy()
    got = collected(C.impute_chained(to_spark(spark, frame).repartition(4), cols, 4, 1e-9, block), cols)
    assert np.allclose(got, plain(raw, 4, 1e-9), atol=1e-8)
    assert np.array_equal(got[~np.isnan(raw)], raw[~np.isnan(raw)])


def test_stops_when_nothing_moves_and_keeps_odd_columns(spark):
    frame = panel_frame(n=60, width=5, gaps=0.2, seed=1)
    frame["r1"], frame["r4"] = np.nan, 1.0
    cols = returns(frame)
    df = to_spark(spark, frame)
    start, updates = C.fit_chain(df.select(C.S.pack(cols).alias("r")), 5, 50, 0.05)
    assert 0 < len(updates) < 50 * 3 and {f for f, _ in updates} == {0, 2, 3}
    got = collected(C.impute_chained(df, cols, 50, 0.05), cols)
    assert np.isnan(got[:, 1]).all() and not np.isnan(np.delete(got, 1, 1)).any()
    raw = frame.sort_values("ID")[cols].to_numpy()
    assert np.allclose(np.delete(got, 1, 1), np.delete(plain(raw, 50, 0.05), 1, 1), atol=1e-8)
    assert C.impute_chained(df.limit(0), cols).count() == 0
