"""Small random panels."""

import numpy as np
import pandas as pd


def panel_frame(n=60, width=53, gaps=0.3, equities=3, seed=0) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 1))
    values = (base + rng.normal(size=(n, width))).round(4)
    values[rng.random((n, width)) < gaps] = np.nan
    frame = pd.DataFrame(values, columns=[f"r{i}" for i in range(width)])
    frame.insert(0, "equity", rng.integers(0, equities, n).astype("int32"))
    frame.insert(0, "day", np.arange(n, dtype="int32"))
    frame.insert(0, "ID", np.arange(n, dtype="int64") * 7 + 1)
    frame["reod"] = np.sign(base[:, 0].round()).astype("int32")
    return frame


def to_spark(spark, frame: pd.DataFrame):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(frame)
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def returns(frame):
    return [c for c in frame.columns if c[0] == "r" and c[1:].isdigit()]


def collected(df, columns, key="ID") -> np.ndarray:
    return df.toPandas().sort_values(key)[columns].to_numpy(dtype=float)
