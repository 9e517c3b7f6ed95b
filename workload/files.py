"""Sources, sinks, the registry and text segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import segments as G
from panelspark.plans import datasets as D
from panelspark.schema import TARGET, panel_schema
from panelspark.sources.derived import split_by_key
from panelspark.sources.registry import STRATEGIES, Registry
from panelspark.sources.scratch import scratch_path
from panelspark.sources.tables import read_csv, write_csv
from workload.base import RETURNS, cells, mixed_fill, num, nums, packed, query, sql, stored_kept, stored_panel, whole, wholes
from workload.rows import BASIC, BASIC_COUNTS, BASIC_FLOATS, TECHNICAL, TECHNICAL_NAMES

_registries: dict[tuple[str, str], Registry] = {}
FILLS = (("raw", "raw"), ("ffbf", "ffill_then_bfill"), ("bfff", "bfill_then_ffill"), ("interp", "linear"))
KEYS = list(STRATEGIES)


def registry(spark, sf_dir) -> Registry:
    """Filtered train and test tables under all strategies, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _registries:
        made = Registry(scratch_path(spark, "registry"))
        D.build_datasets(made, *split_by_key(stored_kept(spark, sf_dir)), KEYS)
        _registries[key] = made
    return _registries[key]


@query("s1_csv_scan", sql("SELECT count(*) AS n_rows, " + whole("sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END)", "n_nulls") + f", {num('sum(value)', 'total')} FROM grid WHERE pos = 7"))
def s1(spark, sf_dir):
    """Blanks and NA marks in a CSV are missing values."""
    path = scratch_path(spark, "csv")
    df = stored_panel(spark, sf_dir)
    write_csv(df.withColumn("r7", F.coalesce(F.col("r7").cast("string"), F.when(F.col("day") % 2 == 0, "NA"))), path)
    back = read_csv(spark, path, panel_schema(with_target=True))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("r7").isNull()).alias("n_nulls"), F.sum("r7").alias("total"))


@query("s2_csv_round_trip", sql(cells("panel")))
def s2(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(stored_panel(spark, sf_dir), path)
    return packed(read_csv(spark, path, panel_schema(with_target=True)))


SIDES = """CASE WHEN "ID" % 5 <> 0 THEN 'train' ELSE 'test' END AS side"""


# An imputer of columns leaves a gap only in a column without any value on that side.
MODELLED = f"""SELECT strategy, side, sum(missing) AS gaps FROM (SELECT "ID", {SIDES}, pos,
  CASE WHEN count(value) OVER (PARTITION BY "ID" % 5 <> 0, pos) = 0 THEN 1 ELSE 0 END AS missing
  FROM (SELECT "ID", unnest(range(53)) AS pos, unnest(r) AS value FROM kept)), (SELECT unnest(['mice', 'knn']) AS strategy) GROUP BY strategy, side, "ID" """


@query(
    "s3_s5_dataset_sizes",
    sql("SELECT strategy, side, count(*) AS n_rows, 57::BIGINT AS n_columns, " + whole("sum(gaps)", "n_nulls") + " FROM ("
        + " UNION ALL ".join([*(f"SELECT '{k}' AS strategy, {SIDES}, count(*) - count(value) AS gaps FROM ({mixed_fill(m)}) GROUP BY \"ID\"" for k, m in FILLS), MODELLED])
        + ") GROUP BY strategy, side"),
)
def s5(spark, sf_dir):
    return D.profile_datasets(loaded(spark, sf_dir))[0]


def loaded(spark, sf_dir) -> dict:
    failed: dict[str, str] = {}
    found = D.load_datasets(spark, registry(spark, sf_dir), KEYS, failed)
    if failed:
        raise RuntimeError(f"datasets not loaded: {failed}")
    return found


@query(
    "s5_dataset_classes",
    sql("SELECT strategy, " + whole("reod", "class") + ", count(*) AS n, " + num("count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY strategy)", "percent")
        + f" FROM kept, (SELECT unnest({KEYS!r}) AS strategy) WHERE \"ID\" % 5 <> 0 GROUP BY strategy, reod"),
)
def s5_classes(spark, sf_dir):
    return D.profile_datasets(loaded(spark, sf_dir))[1]


KEPT_LONG = f'(SELECT "ID", {SIDES}, day, equity, reod, unnest(range(53)) AS pos, unnest(r) AS value FROM kept)'
NORMED = f"""SELECT "ID", side, day, equity, reod, pos, coalesce((value - avg(value) OVER w) / (stddev_samp(value) OVER w + 1e-8), 0) AS value
  FROM {KEPT_LONG} WINDOW w AS (PARTITION BY "ID")"""


def both_sides(pair):
    train, test = pair
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query("s6_load_for_analysis", sql(f"SELECT side, {wholes('ID', 'day', 'equity', 'reod', 'pos')}, {nums('value')} FROM ({NORMED})"))
def s6(spark, sf_dir):
    return packed(both_sides(D.load_for_analysis(spark, registry(spark, sf_dir), "raw", normalise=True)), ("side", "day", "equity", TARGET))


@query("s7_load_without_identifiers", sql(f"SELECT side, {wholes('ID', 'reod', 'pos')}, {num('coalesce(value, 0)', 'value')} FROM {KEPT_LONG}"))
def s7(spark, sf_dir):
    pair = D.load_for_analysis(spark, registry(spark, sf_dir), "raw", with_identifiers=False)
    assert not {"day", "equity"} & {c for df in pair for c in df.columns}
    return packed(both_sides(pair), ("side", TARGET))


FEATURES_OF = f'{wholes("ID")}, {nums(*BASIC_FLOATS, *TECHNICAL_NAMES)}, {wholes(*BASIC_COUNTS)}'


def with_features(spark, sf_dir, keys):
    known, failed = registry(spark, sf_dir), {}
    done = D.precompute_features(spark, known, keys, failed)
    if failed:
        raise RuntimeError(f"no features for {failed}")
    return {key: both_sides(known.read(spark, name)) for key, name in zip(keys, done)}


def stacked(tables: dict):
    out = None
    for key, df in tables.items():
        part = df.withColumn("strategy", F.lit(key)).drop("day", "equity", TARGET, *RETURNS)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "s4_s8_precomputed_features",
    sql(" UNION ALL ".join(f'SELECT \'{k}\' AS strategy, {SIDES}, {FEATURES_OF} FROM (SELECT "ID", {BASIC}, {TECHNICAL} FROM ({mixed_fill(m)}) GROUP BY "ID")' for k, m in FILLS)),
)
def s8(spark, sf_dir):
    return stacked(with_features(spark, sf_dir, [k for k, _ in FILLS]))


@query("s8_features_of_imputed")
def s8_imputed(spark, sf_dir):
    """The two strategies whose values come from a model."""
    return stacked(with_features(spark, sf_dir, ["mice", "knn"]))


# --- segments -----------------------------------------------------------------------------------


def conversations(spark, sf_dir):
    """Turns as typed segments: assistant = code, user = markdown, system = left out."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    kind = F.when(F.col("role") == "assistant", "code").when(F.col("role") == "user", "markdown").otherwise("raw")
    return turns.select(F.col("conv_id").alias("doc"), F.col("turn").alias("pos"), kind.alias("kind"), "text")


SEGMENTS = """seg AS (SELECT conv_id AS doc, turn AS pos, CASE role WHEN 'assistant' THEN 'code' ELSE 'markdown' END AS kind, text,
   string_split(text, chr(10)) AS l FROM conversations WHERE role IN ('assistant', 'user')),
 body AS (SELECT doc, pos, kind, CASE WHEN kind = 'code' THEN text ELSE array_to_string(list_transform(l, lambda x, i:
   CASE WHEN x LIKE '#%' OR (i = len(l) AND x = '') THEN x ELSE '# ' || x END), chr(10)) END AS b FROM seg)"""


@query(
    "s9_join_segments",
    f"""WITH {SEGMENTS} SELECT doc, CAST(pos // 1000 AS BIGINT) AS part, string_agg(CASE kind WHEN 'code' THEN '# --- Code Cell' ELSE '# --- Markdown Cell' END
      || ' ---' || chr(10) || b || chr(10), '' ORDER BY pos) AS text FROM body GROUP BY ALL""",
)
def s9(spark, sf_dir):
    return G.join_segments(conversations(spark, sf_dir))


@query(
    "s10_split_segments",
    f"""WITH {SEGMENTS} SELECT * FROM (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY pos) AS cell, CAST(pos // 2 AS BIGINT) AS part, kind,
      regexp_replace(b, '^\\n+|\\n+$', '', 'g') AS text FROM body) WHERE text <> ''""",
)
def s10(spark, sf_dir):
    """Join, then split again. Two segments per part, so that parts have to work together."""
    return G.split_segments(G.join_segments(conversations(spark, sf_dir), part_segments=2))
