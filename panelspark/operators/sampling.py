"""Row and column samples and train/validation splits that depend on keys, not on row order."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.sketch import hash_unit
from panelspark.schema import KEY


def sample_rows(df: DataFrame, n: int, key: str = KEY, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest key hash; the frame itself if it is not larger.

    A first cut by hash value leaves a little more than ``n`` rows, so the final ordering
    works on about ``n`` rows instead of on a top-n list from every partition.
    """
    total = df.count()
    if total <= n:
        return df
    u = hash_unit(F.col(key), seed)
    cut = (n + 6.0 * math.sqrt(n) + 10.0) / total
    marked = df.withColumn("__u", u)
    small = marked.where(F.col("__u") < cut)
    if cut < 1.0 and small.count() < n:
        small = marked
    return small.orderBy("__u", key).limit(n).drop("__u")


def sample_columns(columns: Sequence[str], n: int = 5, seed: int = 42) -> list[str]:
    """At most ``n`` of the columns."""
    columns = list(columns)
    return random.Random(seed).sample(columns, min(n, len(columns)))


def split_rows(df: DataFrame, train_share: float = 0.8, key: str = KEY, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by key hash."""
    u = hash_unit(F.col(key), seed)
    return df.where(u < train_share), df.where(u >= train_share)
