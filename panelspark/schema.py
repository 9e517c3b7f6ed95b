"""Column conventions of a return panel.

A panel row is one (day, entity). Interval columns are named ``r0``, ``r1``, ...;
their order in the DataFrame is the time order. Everything here only looks at the
schema, so no Spark job is started.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "ID"
TARGET = "reod"
# Number of five-minute intervals and the class labels.
N_INTERVALS = 53
CLASSES = (-1, 0, 1)

_RETURN = re.compile(r"r\d+")


def return_columns(df: DataFrame) -> list[str]:
    """Interval columns in DataFrame order (``reod`` and ``r_mean`` are not)."""
    return [c for c in df.columns if _RETURN.fullmatch(c)]


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` inclusive, by position."""
    names = df.columns
    return names[names.index(first): names.index(last) + 1]


def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    drop = set(excluded)
    return [c for c in df.columns if c not in drop]


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns that a transformation added."""
    return columns_except(after, before.columns)


def feature_groups(df: DataFrame) -> dict[str, list[str]]:
    """Group columns by what their name says they hold."""
    names = df.columns
    rolled = [c for c in names if "roll" in c]
    moved = [c for c in names if "momentum" in c]
    return {
        "returns": return_columns(df),
        "basic_stats": [c for c in names if c.startswith("r_") and c not in rolled and c not in moved],
        "rolling": rolled,
        "momentum": moved,
    }


def panel_schema(n_intervals: int = N_INTERVALS, with_target: bool = False) -> T.StructType:
    fields = [
        T.StructField(KEY, T.LongType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("equity", T.IntegerType()),
    ]
    fields += [T.StructField(f"r{i}", T.DoubleType()) for i in range(n_intervals)]
    if with_target:
        fields.append(T.StructField(TARGET, T.IntegerType()))
    return T.StructType(fields)


def label_schema() -> T.StructType:
    return T.StructType([T.StructField(KEY, T.LongType()), T.StructField(TARGET, T.IntegerType())])


# Expressions over dozens of columns are written as SQL text: building them Column by Column costs
# a call into the JVM for every node.


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number_sql(name: str) -> str:
    """Column as double; text that is no number and NaN become NULL."""
    return f"nanvl(try_cast({quoted(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def as_number(name: str) -> Column:
    return F.expr(number_sql(name))


def literal(value) -> str:
    """SQL literal of a plain Python value, exact for doubles."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_array(values: Sequence, kind: str | None = None) -> Column:
    items = f"array({', '.join(literal(v) for v in values)})"
    return F.expr(f"CAST({items} AS ARRAY<{kind}>)" if kind else items)


def replace_columns(df: DataFrame, new: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Put SQL expressions in the place of existing columns, keeping the order."""
    names = [c for c in df.columns if c not in drop]
    return df.selectExpr(*[f"{new.get(c, quoted(c))} AS {quoted(c)}" for c in names])


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parse the given columns as double where they are not numeric yet; bad values become NULL."""
    wanted = {c: number_sql(c) for c in columns if c in df.columns and not is_numeric(df, c)}
    return replace_columns(df, wanted) if wanted else df
