"""Building, loading and profiling the imputed datasets."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.features import add_features, fill_rows, normalise_rows
from panelspark.operators.impute import keep_observed_rows
from panelspark.operators.iterative import impute_iterative
from panelspark.operators.neighbours import impute_neighbours
from panelspark.operators.pool import side_by_side
from panelspark.operators.profile import class_shares, table_size
from panelspark.schema import KEY, TARGET
from panelspark.sources.registry import FEATURE_SUFFIX, STRATEGIES, Registry
from panelspark.sources.tables import join_labels, write_parquet

log = logging.getLogger(__name__)

# What each strategy does to the filtered panel. Train and test are treated separately.
IMPUTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "raw": lambda df: df,
    "ffbf": lambda df: fill_rows(df, "ffill_then_bfill"),
    "bfff": lambda df: fill_rows(df, "bfill_then_ffill"),
    "interp": lambda df: fill_rows(df, "linear"),
    "knn": impute_neighbours,
    "mice": impute_iterative,
}


def filtered_panel(features: DataFrame, labels: DataFrame, share: float = 0.7) -> DataFrame:
    """Join the label and keep rows with enough observed values."""
    return keep_observed_rows(join_labels(features, labels), share)


def imputed(panel: DataFrame, strategies: Sequence[str] = tuple(STRATEGIES)) -> dict[str, DataFrame]:
    return {key: IMPUTERS[key](panel) for key in strategies}


def build_datasets(
    registry: Registry, train: DataFrame, test: DataFrame, strategies: Sequence[str] = tuple(STRATEGIES)
) -> None:
    """Write the imputed train and test tables of each strategy, side by side: rounds of small jobs and long ones share the cores."""
    work = []
    # The models come last in the catalogue and take longest, so they begin first.
    for key in reversed(dict.fromkeys(strategies)):
        imputer, entry = IMPUTERS[key], registry.entry(key)
        work += [lambda f=imputer, df=df, path=path: write_parquet(f(df), path) for df, path in ((train, entry.train), (test, entry.test))]
    side_by_side(train.sparkSession, work)


def precompute_features(
    spark: SparkSession, registry: Registry, strategies: Sequence[str] = tuple(STRATEGIES), failed: dict[str, str] | None = None
) -> list[str]:
    """Write ``<key>_with_features`` for every strategy that can be read, side by side; returns the new keys. ``failed`` gets the
    others with their errors."""

    def one(key: str) -> str | None:
        try:
            train, test = registry.read(spark, key)
            registry.write(key + FEATURE_SUFFIX, add_features(train), add_features(test))
        except (PySparkException, Py4JError, ValueError) as error:  # one missing dataset must not stop the others
            log.warning("no features for dataset %s: %s", key, error)
            return str(error)
        return None

    keys = list(dict.fromkeys(strategies))
    errors = dict(zip(keys, side_by_side(spark, [lambda k=key: one(k) for key in keys])))
    if failed is not None:
        failed |= {key: error for key, error in errors.items() if error is not None}
    return [key + FEATURE_SUFFIX for key in strategies if errors[key] is None]


def load_datasets(
    spark: SparkSession, registry: Registry, strategies: Sequence[str] = tuple(STRATEGIES), failed: dict[str, str] | None = None
) -> dict[str, dict]:
    """{key: {train, test, description}} of the datasets that can be read. ``failed`` gets the others with their errors."""
    loaded = {}
    for key in strategies:
        if key not in registry:
            if failed is not None:
                failed[key] = "not registered"
            continue
        try:
            train, test = registry.read(spark, key)
            loaded[key] = {"train": train, "test": test, "description": registry[key].description}
        except (PySparkException, Py4JError) as error:
            log.warning("dataset %s was not loaded: %s", key, error)
            if failed is not None:
                failed[key] = str(error)
    return loaded


def profile_datasets(datasets: Mapping[str, Mapping[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(sizes, class shares): sizes per strategy and side, shares of the training labels per strategy."""
    sizes, shares = [], []
    for key, entry in datasets.items():
        for side in ("train", "test"):
            sizes.append(table_size(entry[side]).select(F.lit(key).alias("strategy"), F.lit(side).alias("side"), "*"))
        if TARGET in entry["train"].columns:
            shares.append(class_shares(entry["train"]).select(F.lit(key).alias("strategy"), "*"))
    return _stack(sizes), _stack(shares)


def _stack(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def prepare_for_analysis(df: DataFrame, normalise: bool = False, with_identifiers: bool = True) -> DataFrame:
    """Features without gaps next to the key and the label.

    Rows are normalised before zero filling. Without identifiers ``day`` and ``equity`` go as well.
    """
    out = normalise_rows(df) if normalise else df
    out = out.na.fill(0, [c for c in out.columns if c not in (KEY, TARGET)])
    return out if with_identifiers else out.drop("day", "equity")


def load_for_analysis(
    spark: SparkSession, registry: Registry, key: str, normalise: bool = False, with_identifiers: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, test), each with key, label and gap-free features. Unknown keys raise."""
    train, test = registry.read(spark, key)
    return tuple(prepare_for_analysis(df, normalise, with_identifiers) for df in (train, test))
