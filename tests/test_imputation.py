import numpy as np
import pandas as pd
import pytest

from panelspark.operators.features import fill_rows
from panelspark.operators.impute import fill_down, inverse_standardise, standardise
from panelspark.operators.iterative import impute_iterative
from panelspark.operators.neighbours import impute_neighbours
from tests.data import collected, panel_frame, returns, to_spark

PANDAS = {
    "ffill": lambda x, a: x.ffill(axis=a),
    "bfill": lambda x, a: x.bfill(axis=a),
    "ffill_then_bfill": lambda x, a: x.ffill(axis=a).bfill(axis=a),
    "bfill_then_ffill": lambda x, a: x.bfill(axis=a).ffill(axis=a),
    "linear": lambda x, a: x.interpolate(axis=a).ffill(axis=a).bfill(axis=a),
}


def edge_rows() -> pd.DataFrame:
    n = np.nan
    rows = [[n] * 6, [1, n, n, n, n, n], [n, n, 2, n, n, n], [1, 2, n, n, 5, 6], [n, 1, 2, 3, 4, 5], [1, 2, 3, 4, 5, n], [0] * 6]
    frame = pd.DataFrame(np.array(rows, dtype=float), columns=[f"r{i}" for i in range(6)])
    frame.insert(0, "ID", np.arange(len(frame), dtype="int64"))
    return frame


@pytest.mark.parametrize("method", PANDAS)
def test_fills_along_rows(spark, method):
    for frame in (edge_rows(), panel_frame(gaps=0.6, seed=3)):
        cols = returns(frame)
        got = collected(fill_rows(to_spark(spark, frame), method), cols)
        np.testing.assert_allclose(got, PANDAS[method](frame[cols], 1).to_numpy(), equal_nan=True)


def test_unknown_fill(spark):
    with pytest.raises(ValueError):
        fill_rows(to_spark(spark, edge_rows()), "sideways")


@pytest.mark.parametrize("method", PANDAS)
@pytest.mark.parametrize("chunks", [1, 5])
def test_fills_down_rows(spark, method, chunks):
    frame = panel_frame(n=50, width=3, gaps=0.7, seed=5)
    # one key holds most rows, so it is cut into ranges
    frame["equity"] = np.where(np.arange(50) % 10 == 0, 1, 0).astype("int32")
    cols = returns(frame)
    want = frame.copy()
    for _, part in frame.groupby("equity"):
        want.loc[part.index, cols] = PANDAS[method](part[cols], 0)
    got = fill_down(to_spark(spark, frame), cols, ["equity"], "day", method, chunks)
    np.testing.assert_allclose(collected(got, cols), want[cols].to_numpy(), equal_nan=True)


def test_fill_down_keeps_rows_with_null_keys_and_ties(spark):
    rows = [(1, None, 1, 1.0), (2, None, 2, None), (3, 1, 1, None), (4, 1, 1, 5.0), (5, 1, 2, None), (5, 1, 2, None), (6, None, None, None)]
    df = spark.createDataFrame(rows, "ID long, equity int, day int, r0 double")
    for method in ("ffill", "bfill", "ffill_then_bfill", "bfill_then_ffill", "linear"):
        got = fill_down(df, ["r0"], ["equity"], "day", method, 3).collect()
        assert sorted(r["ID"] for r in got) == [1, 2, 3, 4, 5, 5, 6]
    filled = {r["ID"]: r["r0"] for r in fill_down(df, ["r0"], ["equity"], "day", "ffill", 3).collect()}
    assert filled[2] == 1.0 and filled[5] == 5.0 and filled[6] is None


def test_standardise_and_back(spark):
    frame = panel_frame(seed=2)
    cols = returns(frame)
    scaled, stats = standardise(to_spark(spark, frame), cols)
    values = frame[cols]
    np.testing.assert_allclose(collected(scaled, cols), ((values - values.mean()) / values.std()).to_numpy(), equal_nan=True)
    np.testing.assert_allclose(collected(inverse_standardise(scaled, stats), cols), values.to_numpy(), equal_nan=True)


def brute_neighbours(x: np.ndarray, k: int = 5) -> np.ndarray:
    mean, std = np.nanmean(x, axis=0), np.nanstd(x, axis=0, ddof=1)
    z = (x - mean) / std
    out = z.copy()
    for i in range(len(z)):
        for f in np.flatnonzero(np.isnan(z[i])):
            donors = []
            for j in range(len(z)):
                both = ~np.isnan(z[i]) & ~np.isnan(z[j])
                if not np.isnan(z[j, f]) and both.any():
                    d = np.sqrt(((z[i, both] - z[j, both]) ** 2).sum() * z.shape[1] / both.sum())
                    donors.append((round(d, 12), j))
            out[i, f] = np.mean([z[j, f] for _, j in sorted(donors)[:k]]) if donors else 0.0
    return out * std + mean


@pytest.mark.parametrize("block_rows", [1000, 20])
def test_neighbours_global(spark, block_rows):
    frame = panel_frame(n=70, width=8, gaps=0.35, seed=11)
    cols = returns(frame)
    got = impute_neighbours(to_spark(spark, frame), block_rows=block_rows)
    assert got.columns == list(frame.columns)
    np.testing.assert_allclose(collected(got, cols), brute_neighbours(frame[cols].to_numpy()), atol=1e-9)


def test_neighbours_by_key_with_a_hot_key(spark):
    frame = panel_frame(n=90, width=6, gaps=0.3, seed=12)
    frame["equity"] = np.where(np.arange(90) < 60, 0, np.arange(90) % 2 + 1).astype("int32")
    cols = returns(frame)
    want = frame.copy()
    for _, part in frame.groupby("equity"):
        want.loc[part.index, cols] = brute_neighbours(part[cols].to_numpy())
    got = impute_neighbours(to_spark(spark, frame), by=["equity"], block_rows=16)
    np.testing.assert_allclose(collected(got, cols), want[cols].to_numpy(), atol=1e-9)


def test_iterative_recovers_linear_structure(spark):
    rng = np.random.default_rng(4)
    hidden = rng.normal(size=(300, 2))
    x = hidden @ rng.normal(size=(2, 7)) + 0.01 * rng.normal(size=(300, 7))
    full = x.copy()
    x[rng.random(x.shape) < 0.2] = np.nan
    frame = pd.DataFrame(x, columns=[f"r{i}" for i in range(7)])
    frame.insert(0, "ID", np.arange(300, dtype="int64"))
    df = to_spark(spark, frame).repartition(3)
    got = collected(impute_iterative(df), returns(frame))
    gaps = np.isnan(x)
    np.testing.assert_allclose(got[~gaps], x[~gaps])
    error = np.sqrt(np.mean((got[gaps] - full[gaps]) ** 2))
    mean_error = np.sqrt(np.mean((np.broadcast_to(np.nanmean(x, 0), x.shape)[gaps] - full[gaps]) ** 2))
    assert error < 0.3 * mean_error


def test_iterative_first_round_is_ridge_on_mean_filled(spark):
    """One round equals ridge-free least squares when noise is tiny and rows are many."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=400)
    frame = pd.DataFrame({"ID": np.arange(400), "r0": a, "r1": 2 * a + 1})
    frame.loc[:9, "r1"] = np.nan
    got = collected(impute_iterative(to_spark(spark, frame), rounds=1), ["r1"])[:, 0]
    np.testing.assert_allclose(got[:10], (2 * a + 1)[:10], atol=1e-3)


def test_imputers_keep_rows_with_null_keys_and_repeated_ids(spark):
    rows = [(1, 1, 1.0, 2.0), (1, 1, None, 3.0), (2, 1, 2.0, None), (3, None, 4.0, 1.0), (4, None, None, 2.0), (5, 2, None, None)]
    df = spark.createDataFrame(rows, "ID long, equity int, r0 double, r1 double")
    for got in (impute_neighbours(df), impute_neighbours(df, by=["equity"]), impute_iterative(df)):
        assert sorted(r["ID"] for r in got.collect()) == [1, 1, 2, 3, 4, 5]


def test_neighbours_hand_on_the_best_donors_alone(spark, monkeypatch):
    """However many blocks there are, a gap leaves its task with k candidates, and rows travel once a block."""
    from panelspark.operators import neighbours

    seen = []
    inner = neighbours.meet

    def spy(held, visitors, *rest):
        out = inner(held, visitors, *rest)
        seen.append((held.count(), visitors.count(), out.count()))
        return out

    monkeypatch.setattr(neighbours, "meet", spy)
    monkeypatch.setattr(neighbours, "BLOCKS", 4)
    frame = panel_frame(n=90, width=6, gaps=0.3, seed=13)
    cols = returns(frame)
    got = impute_neighbours(to_spark(spark, frame), block_rows=10)
    np.testing.assert_allclose(collected(got, cols), brute_neighbours(frame[cols].to_numpy()), atol=1e-9)
    (held, visitors, handed_on), = seen
    assert (held, visitors) == (90, 4 * 90) and handed_on <= 5 * frame[cols].isna().to_numpy().sum()


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_neighbours_sift_by_one_product_and_lose_no_pair(scale):
    """Close rows far from 0, ties, rows without a column in common and a column with fewer donors than asked for."""
    from panelspark.operators import neighbours

    class Counted(np.ndarray):
        products = 0

        def __matmul__(self, other):
            Counted.products += 1
            return np.asarray(self) @ np.asarray(other)

    rng = np.random.default_rng(6)
    x = (rng.normal(size=(300, 9)) + scale * rng.integers(-3, 4, (300, 1))).round(2)
    x[rng.random(x.shape) < 0.3] = np.nan
    x[5:9, :5], x[9:13, 5:], x[3:, 2] = np.nan, np.nan, np.nan
    x[200:240] = x[100:140]
    ids, k = np.arange(300), 5
    queries = neighbours._Queries(ids, x, k)
    queries.left = queries.left.view(Counted)
    if hasattr(queries, "flat"):
        queries.flat = queries.flat.view(Counted)
    visits = range(0, 300, 32)
    for at in visits:
        queries.meet(ids[at:at + 32], x[at:at + 32])
    assert Counted.products == len(visits)
    both = ~np.isnan(x[:, None]) & ~np.isnan(x[None])
    with np.errstate(invalid="ignore", divide="ignore"):
        apart = np.round(np.sqrt((np.where(both, x[:, None] - x[None], 0) ** 2).sum(2) * 9 / both.sum(2)), 12)
    for row, i in enumerate(queries.ids):
        for f in np.flatnonzero(np.isnan(x[i])):
            want = sorted((apart[i, j], j) for j in ids if not np.isnan(x[j, f]) and both[i, j].any())[:k]
            found = np.isfinite(queries.distance[row, f])
            assert list(zip(queries.distance[row, f][found], queries.donor[row, f][found])) == want
