"""Shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def _base(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="panelspark-")
    return _local[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{_base(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet under the shared folder and read back; several later passes see the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later steps restart from stored data, also after losing executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_base(spark))
    return df.checkpoint()
