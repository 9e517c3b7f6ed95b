"""Named train/test datasets."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelspark.sources.tables import read_csv, read_parquet, write_parquet

# The imputation strategies and what they stand for.
STRATEGIES = {
    "raw": "rows with enough observed values",
    "ffbf": "forward fill, then backward fill",
    "bfff": "backward fill, then forward fill",
    "interp": "linear interpolation, edges filled",
    "mice": "iterative imputation",
    "knn": "nearest-neighbour imputation",
}
FEATURE_SUFFIX = "_with_features"


@dataclass(frozen=True)
class Dataset:
    train: str
    test: str
    description: str


class Registry:
    """Maps a dataset key to the paths of its train and test table under one root folder."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self._entries: dict[str, Dataset] = {}
        for key, text in STRATEGIES.items():
            self._entries[key] = self._default(key, text)
            self._entries[key + FEATURE_SUFFIX] = self._default(key + FEATURE_SUFFIX, text + ", with features")

    def _default(self, key: str, text: str) -> Dataset:
        return Dataset(f"{self.root}/{key}/train", f"{self.root}/{key}/test", text)

    def keys(self) -> list[str]:
        return list(self._entries)

    def __contains__(self, key: str) -> bool:
        return key in self._entries

    def __getitem__(self, key: str) -> Dataset:
        if key not in self._entries:
            raise ValueError(f"dataset {key!r} is not registered")
        return self._entries[key]

    def register(self, key: str, train: str, test: str, description: str) -> bool:
        """Add a dataset or replace it (with a warning)."""
        if key in self._entries:
            warnings.warn(f"dataset {key!r} is already registered and is replaced", stacklevel=2)
        self._entries[key] = Dataset(train, test, description)
        return True

    def write(self, key: str, train: DataFrame, test: DataFrame, description: str | None = None) -> Dataset:
        """Materialise both tables under the key's paths, adding the key if it is new."""
        entry = self.entry(key, description)
        write_parquet(train, entry.train)
        write_parquet(test, entry.test)
        return entry

    def entry(self, key: str, description: str | None = None) -> Dataset:
        """The key's dataset; a new key is added under the root folder."""
        if key not in self:
            self.register(key, *self._default_paths(key), description or key)
        return self[key]

    def _default_paths(self, key: str) -> tuple[str, str]:
        entry = self._default(key, key)
        return entry.train, entry.test

    def read(self, spark: SparkSession, key: str, schema=None) -> tuple[DataFrame, DataFrame]:
        """Lazy (train, test). Paths ending in ``.csv`` need a schema."""
        entry = self[key]

        def one(path: str) -> DataFrame:
            return read_csv(spark, path, schema) if path.endswith(".csv") else read_parquet(spark, path)

        return one(entry.train), one(entry.test)

    def create_views(self, spark: SparkSession, key: str) -> None:
        """Expose a dataset to SQL as ``<key>_train`` and ``<key>_test``."""
        for side, df in zip(("train", "test"), self.read(spark, key)):
            df.createOrReplaceTempView(f"{key}_{side}")
