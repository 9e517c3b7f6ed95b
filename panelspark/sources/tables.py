"""Reading and writing panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.schema import KEY


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. Fields are read as text and parsed leniently, so any blank or
    non-numeric mark (``NA``, ``nan``, ...) is missing. Columns are matched by header name."""
    text = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    parsed = []
    for field in schema.fields:
        value = F.trim(F.col(f"`{field.name}`")).try_cast("double") if isinstance(
            field.dataType, T.NumericType
        ) else F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            # Try the integer form first: ids beyond 2**53 do not survive a double.
            exact = F.trim(F.col(f"`{field.name}`")).try_cast(field.dataType)
            value = F.coalesce(exact, value.try_cast(field.dataType))
        elif isinstance(field.dataType, T.FractionalType):
            value = F.when(~F.isnan(value), value).cast(field.dataType)
        parsed.append(value.alias(field.name))
    return text.select(*parsed)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet panel with NaN turned into NULL."""
    df = spark.read.parquet(path)
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    clean = {c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in doubles}
    return df.withColumns(clean) if clean else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def join_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach the label by key; rows without a partner are dropped."""
    return features.join(labels, KEY, "inner")


def sorted_output(df: DataFrame) -> DataFrame:
    """Total order by key, meant for the last step before a sink."""
    return df.orderBy(KEY)
