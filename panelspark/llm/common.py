"""Reading tables, shared text expressions, stored intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources.scratch import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The white space between words, U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to a fresh path in the shared folder and read back: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of characters that are none of BLANKS, in order."""
    spaced = F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where lambdas inside the body use it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
