import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import features as X
from panelspark.schema import column_range, feature_groups, new_columns, panel_schema, return_columns
from tests.data import collected, panel_frame, returns, to_spark


def wide_edges() -> pd.DataFrame:
    n, width = np.nan, 53
    rows = np.full((6, width), n)
    rows[1, 10] = 3.0
    rows[2, 40:] = np.arange(13)
    rows[3, :40] = -1.5
    rows[4] = 2.0
    rows[5] = 0.0
    frame = pd.DataFrame(rows, columns=[f"r{i}" for i in range(width)])
    frame.insert(0, "ID", np.arange(6, dtype="int64"))
    return frame


def expected(frame: pd.DataFrame) -> pd.DataFrame:
    x = frame[returns(frame)]
    out = pd.DataFrame({
        "r_mean": x.mean(axis=1), "r_std": x.std(axis=1), "r_min": x.min(axis=1), "r_max": x.max(axis=1), "r_sum": x.sum(axis=1),
        "r_pos_count": (x > 0).sum(axis=1), "r_neg_count": (x < 0).sum(axis=1), "r_zero_count": (x == 0).sum(axis=1),
        "r_pos_sum": x.where(x > 0).sum(axis=1), "r_neg_sum": x.where(x < 0).sum(axis=1),
    })
    for w in (5, 10, 20):
        out[f"r_roll_mean_{w}"] = x.iloc[:, -w:].mean(axis=1).where(x.iloc[:, -w:].notna().all(axis=1))
        out[f"r_roll_std_{w}"] = x.iloc[:, -w:].std(axis=1).where(x.iloc[:, -w:].notna().all(axis=1))
    for lag in (5, 10):
        out[f"r_momentum_{lag}"] = x.iloc[:, -1] - x.iloc[:, -1 - lag]
    return out


@pytest.mark.parametrize("frame", [wide_edges(), panel_frame(seed=1), panel_frame(gaps=0.05, seed=2)], ids=["edges", "gaps", "few gaps"])
def test_features_equal_pandas(spark, frame):
    want = expected(frame)
    got = X.add_features(to_spark(spark, frame))
    assert list(got.columns) == [*frame.columns, *want.columns]
    np.testing.assert_allclose(collected(got, list(want.columns)), want.to_numpy(dtype=float), atol=1e-9, equal_nan=True)


def test_feature_sets_and_frames_without_returns(spark):
    df = to_spark(spark, panel_frame())
    assert len(new_columns(df, X.add_features(df, ["technical"]))) == 8
    assert len(new_columns(df, X.add_features(df, ["basic_stats"]))) == 10
    plain = df.select("ID", "reod")
    assert X.add_features(plain).columns == plain.columns == X.add_financial_features(plain).columns


def test_narrow_panels_get_fewer_features(spark):
    df = to_spark(spark, panel_frame(width=8))
    assert [c for c in X.add_features(df, ["technical"]).columns if "r_" in c] == ["r_roll_mean_5", "r_roll_std_5"]
    assert new_columns(df, X.add_financial_features(df)) == ["pos_ratio", "neg_ratio"]


@pytest.mark.parametrize("frame", [wide_edges(), panel_frame(seed=4)], ids=["edges", "gaps"])
def test_financial_features(spark, frame):
    x = frame[returns(frame)]
    want = pd.DataFrame({f"volatility_{w}": x.iloc[:, :w].std(axis=1) for w in (10, 20, 30)})
    want["sharpe_ratio"] = x.iloc[:, :20].mean(axis=1) / (x.iloc[:, :20].std(axis=1) + 1e-8)
    want["momentum"] = x.iloc[:, 30:40].mean(axis=1) - x.iloc[:, 10:20].mean(axis=1)

    def slope(row):
        seen = np.flatnonzero(~np.isnan(row))
        return np.polyfit(seen, row[seen], 1)[0] if len(seen) > 1 else 0.0

    want["trend_slope"] = [slope(r) for r in x.iloc[:, :30].to_numpy()]
    want["pos_ratio"], want["neg_ratio"] = (x > 0).sum(axis=1) / 53, (x < 0).sum(axis=1) / 53
    got = X.add_financial_features(to_spark(spark, frame))
    np.testing.assert_allclose(collected(got, list(want.columns)), want.fillna(0).to_numpy(), rtol=1e-7, atol=1e-9)


def test_row_normalisation(spark):
    frame = panel_frame(seed=9)
    cols = returns(frame)
    got = collected(X.normalise_rows(to_spark(spark, frame)), cols)
    x = frame[cols]
    want = x.sub(x.mean(axis=1), axis=0).div(x.std(axis=1) + 1e-8, axis=0).fillna(0)
    np.testing.assert_allclose(got, want.to_numpy(), atol=1e-9)
    plain = collected(X.normalise_rows_plain(to_spark(spark, wide_edges())), cols)
    assert np.isnan(plain[0]).all() and np.isnan(plain[4]).all() and not np.isnan(plain[1]).any()


def test_signature_equals_stepwise_products(spark):
    frame = panel_frame(seed=13)
    p = frame[returns(frame)].fillna(0).cumsum(axis=1).to_numpy()
    path = np.stack([p[:, 1:], p[:, :-1]], axis=-1)
    first, second = np.zeros((len(p), 2)), np.zeros((len(p), 2, 2))
    for t in range(path.shape[1] - 1):
        d = path[:, t + 1] - path[:, t]
        second += np.einsum("ni,nj->nij", first, d) + 0.5 * np.einsum("ni,nj->nij", d, d)
        first += d
    got = collected(X.add_signature(to_spark(spark, frame)), ["s1", "s2", "s11", "s12", "s21", "s22", "null_count"])
    np.testing.assert_allclose(got[:, :2], first, atol=1e-9)
    np.testing.assert_allclose(got[:, 2:6], second.reshape(-1, 4), atol=1e-8)
    np.testing.assert_array_equal(got[:, 6], frame[returns(frame)].isna().sum(axis=1))


def test_column_names(spark):
    df = to_spark(spark, panel_frame())
    featured = X.add_features(df)
    assert return_columns(featured) == [f"r{i}" for i in range(53)]
    assert column_range(df, "day", "r1") == ["day", "equity", "r0", "r1"]
    groups = feature_groups(featured)
    assert [len(groups[g]) for g in ("returns", "basic_stats", "rolling", "momentum")] == [53, 10, 6, 2]


def test_nan_and_text_count_as_missing(spark):
    frame = pd.DataFrame({"ID": [1], "r0": [np.nan], "r1": [2.0]})
    got = X.add_features(spark.createDataFrame(frame), ["basic_stats"]).first()
    assert got["r_max"] == 2.0 and got["r_pos_count"] == 1
    text = spark.createDataFrame([(1, "NA", "4.5")], "ID long, r0 string, r1 string")
    got = X.add_features(text, ["basic_stats"]).first()
    assert got["r_sum"] == 4.5 and got["r0"] is None


@pytest.mark.parametrize("step", [
    X.add_features, X.add_financial_features, X.normalise_rows, X.normalise_rows_plain, X.add_signature, X.add_price_path,
    lambda df: X.fill_rows(df, "linear"), lambda df: X.fill_rows(df, "ffill_then_bfill"),
])
def test_row_work_needs_no_shuffle_and_no_python(spark, step):
    df = spark.range(10).selectExpr("id AS ID", *[f"rand({i}) AS r{i}" for i in range(53)])
    plan = step(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_only_needed_columns_are_read(spark, tmp_path):
    to_spark(spark, panel_frame()).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p")).select("ID", "r0", "r1").where(F.col("ID") > 5)
    plan = X.fill_rows(df, "ffill")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ID:bigint,r0:double,r1:double>" in plan and "GreaterThan(ID,5)" in plan


def test_streaming_gives_the_batch_rows(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    df = to_spark(spark, panel_frame())
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in panel_schema(with_target=True).fields])
    df.write.parquet(source)
    stream = X.add_features(X.fill_rows(spark.readStream.schema(panel_schema(with_target=True)).parquet(source), "linear"))
    run = stream.writeStream.format("parquet").option("path", sink).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    names = ["r_mean", "r_std", "r_sum"]
    np.testing.assert_allclose(
        collected(spark.read.parquet(sink), names), collected(X.add_features(X.fill_rows(df, "linear")), names)
    )
