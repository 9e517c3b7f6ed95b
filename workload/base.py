"""Registration, shared inputs and shared SQL.

Every query returns a DataFrame; doubles are rounded to six digits on both sides so that sums
taken in a different order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions import series as S
from panelspark.schema import KEY, literal, quoted, replace_columns
from panelspark.operators.impute import keep_observed_rows
from panelspark.sources.derived import panel, split_by_key
from panelspark.sources.scratch import scratch_path
from panelspark.sources.tables import write_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RETURNS = [f"r{i}" for i in range(53)]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Means of few values with few decimals often end in an exact half of the last kept digit, where
# the last bit of a sum would decide the rounding. This shift moves them off the border.
NUDGE = 3.7e-9


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits, whole numbers to BIGINT, no negative zero."""
    new = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            new[f.name] = f"round(double({quoted(f.name)}) + {literal(NUDGE)}, {digits}) + 0D"
        elif isinstance(f.dataType, T.IntegralType):
            new[f.name] = f"bigint({quoted(f.name)})"
    return replace_columns(df, new)


# --- Spark inputs -----------------------------------------------------------------------------


_stored: dict[tuple[str, str], str] = {}


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived panel as a table in the shared folder, written once per session and folder.

    For queries that need several passes; it reads back with column pruning and row counts from
    the footers, and a lost executor costs a re-read only.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = scratch_path(spark, "panel")
        write_parquet(panel(spark, sf_dir), path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def stored_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_observed_rows(stored_panel(spark, sf_dir))


def packed(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(ID, extra..., pos, value): the returns of a wide panel in long form, to compare cell by cell."""
    return df.select(KEY, *extra, F.posexplode(S.pack(RETURNS)).alias("pos", "value"))


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_by_key(panel(spark, sf_dir))


# --- SQL --------------------------------------------------------------------------------------

# long: (equity, day, slot, r); grid: one row per panel cell; panel: (ID, day, equity, r list, reod)
CTES = """
WITH k AS (SELECT greatest(1, CAST(floor(count(*) / 2000) AS BIGINT)) AS n FROM events),
b AS (SELECT user_id % (SELECT n FROM k) AS equity, dayofyear(ts) AS day,
             CAST(floor((hour(ts) * 60 + minute(ts)) / 24) AS INT) AS slot, value FROM events),
long AS (SELECT day * 1000 + equity AS "ID", day, equity, slot, round(avg(value) - 50.0, 4) AS r
         FROM b GROUP BY equity, day, slot),
keys AS (SELECT DISTINCT "ID", day, equity FROM long),
grid AS (SELECT keys."ID", keys.day, keys.equity, s.pos, long.r AS value
         FROM keys CROSS JOIN (SELECT CAST(range AS BIGINT) AS pos FROM range(53)) s
         LEFT JOIN long ON long."ID" = keys."ID" AND long.slot = s.pos),
lab AS (SELECT "ID", CASE WHEN e - m > 4 THEN 1 WHEN e - m < -4 THEN -1 ELSE 0 END AS reod
        FROM (SELECT "ID", avg(CASE WHEN slot >= 53 THEN r END) AS e, avg(CASE WHEN slot < 53 THEN r END) AS m
              FROM long GROUP BY "ID")),
panel AS (SELECT grid."ID", grid.day, grid.equity, lab.reod, list(grid.value ORDER BY grid.pos) AS r
          FROM grid JOIN lab ON lab."ID" = grid."ID" GROUP BY ALL),
kept AS (SELECT * FROM panel WHERE 4 + len(list_filter(r, lambda x: x IS NOT NULL)) >= 39)"""


def num(expression: str, name: str) -> str:
    return f'round(CAST({expression} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS "{name}"'


def whole(expression: str, name: str) -> str:
    return f'CAST({expression} AS BIGINT) AS "{name}"'


def nums(*names: str) -> str:
    return ", ".join(num(f'"{n}"', n) for n in names)


def wholes(*names: str) -> str:
    return ", ".join(whole(f'"{n}"', n) for n in names)


def sql(body: str, ctes: str = "") -> str:
    """SQL over the shared relations plus more ``name AS (...)`` ones."""
    return f"{CTES}{', ' + ctes if ctes else ''}\n{body}"


def cells(source: str, where: str = "") -> str:
    """Long form of a relation with a list column ``r``."""
    return (
        f'SELECT "ID", CAST(pos AS BIGINT) AS pos, {num("value", "value")} FROM '
        f'(SELECT "ID", unnest(range(53)) AS pos, unnest(r) AS value FROM {source} {where})'
    )


def mixed_fill(kind: str) -> str:
    """Name and body of a relation ``filled`` (ID, day, equity, pos, value, reod): filled rows of ``kept``."""
    before = "PARTITION BY \"ID\" ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    after = "PARTITION BY \"ID\" ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    prev = f"last_value(value IGNORE NULLS) OVER ({before})"
    nxt = f"first_value(value IGNORE NULLS) OVER ({after})"
    pp = f"last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({before})"
    pn = f"first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({after})"
    value = {
        "ffill": prev,
        "bfill": nxt,
        "ffill_then_bfill": f"coalesce({prev}, {nxt})",
        "bfill_then_ffill": f"coalesce({nxt}, {prev})",
        "linear": f"coalesce(value, {prev} + ({nxt} - {prev}) * (pos - {pp}) / ({pn} - {pp}), {prev}, {nxt})",
        "raw": "value",
    }[kind]
    source = '(SELECT "ID", day, equity, reod, unnest(range(53)) AS pos, unnest(r) AS value FROM kept)'
    return f'SELECT "ID", day, equity, reod, pos, {value} AS value FROM {source}'
