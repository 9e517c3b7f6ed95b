"""Row-wise operators: selection, labels, fills, features, normalisation, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import series as S
from panelspark.operators import features as X
from panelspark.operators import impute as I
from panelspark.operators.models import class_index, index_class, replace_labels
from panelspark.schema import KEY, TARGET, coerce_numeric, column_range, columns_except
from panelspark.sources.derived import panel
from workload.base import RETURNS, cells, mixed_fill, num, nums, packed, query, sql, train_test, wholes

IDS = wholes("ID", "day", "equity")
V = "list_filter(r, lambda x: x IS NOT NULL)"


def kept(spark, sf_dir):
    return I.keep_observed_rows(panel(spark, sf_dir))


# --- the minimum slice --------------------------------------------------------------------------

SLICE_SQL = """SELECT CAST(reod AS BIGINT) AS reod, count(*) AS n, {means} FROM (
  SELECT "ID", reod, avg(value) AS r_mean, stddev_samp(value) AS r_std, min(value) AS r_min, max(value) AS r_max,
         sum(value) AS r_sum, count(*) FILTER (value > 0) AS r_pos_count, count(*) FILTER (value < 0) AS r_neg_count,
         coalesce(regr_slope(value, pos) FILTER (pos < 30), 0.0) AS trend_slope
  FROM filled GROUP BY "ID", reod) GROUP BY reod"""
SLICE = ("r_mean", "r_std", "r_min", "r_max", "r_sum", "r_pos_count", "r_neg_count", "trend_slope")


def feature_means_by_class(df):
    """Fill each row, derive features, average them per class: row work plus one small shuffle."""
    filled = X.fill_rows(df, "ffill_then_bfill")
    featured = X.add_financial_features(X.add_features(filled, ["basic_stats"]))
    return featured.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in SLICE])


@query(
    "flagship_feature_means_by_class",
    sql(SLICE_SQL.format(means=", ".join(num(f"avg({c})", c) for c in SLICE)), f"filled AS ({mixed_fill('ffill_then_bfill')})"),
)
def flagship(spark, sf_dir):
    return feature_means_by_class(kept(spark, sf_dir))


# --- columns ------------------------------------------------------------------------------------


@query("p1_return_columns", sql(cells("panel")))
def p1(spark, sf_dir):
    return packed(panel(spark, sf_dir))


WIDE = ", ".join(num(f"r[{i + 1}]", f"r{i}") for i in range(53))


@query("p2_column_range", sql(f"SELECT {wholes('day', 'equity')}, {WIDE} FROM panel"))
def p2(spark, sf_dir):
    df = panel(spark, sf_dir)
    return df.select(column_range(df, "day", "r52"))


@query("p3_drop_columns", sql(f"SELECT {wholes('ID', 'reod')}, {WIDE} FROM panel"))
def p3(spark, sf_dir):
    return panel(spark, sf_dir).drop("day", "equity", "not_there")


@query("p3b_columns_except", sql(f"SELECT {WIDE} FROM panel"))
def p3b(spark, sf_dir):
    df = panel(spark, sf_dir)
    return df.select(columns_except(df, ["ID", "day", "equity", "reod"]))


@query(
    "p6_numeric_coercion",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('TRY_CAST(t AS DOUBLE)', 'value')} FROM "
        "(SELECT \"ID\", pos, CASE WHEN pos % 7 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS t FROM grid)"),
)
def p6(spark, sf_dir):
    """Panel as text with marks that are no numbers."""
    df = panel(spark, sf_dir)
    text = df.select(KEY, *[
        (F.lit("n/a") if i % 7 == 0 else F.col(c).cast("string")).alias(c) for i, c in enumerate(RETURNS)
    ])
    return packed(coerce_numeric(text, RETURNS))


@query(
    "p7_label_map",
    sql('SELECT "ID"::BIGINT AS "ID", CAST(reod + 1 AS BIGINT) AS mapped, CAST(CASE reod WHEN -1 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS BIGINT) AS replaced, '
        "CAST(reod AS BIGINT) AS restored FROM lab"),
)
def p7(spark, sf_dir):
    df = panel(spark, sf_dir).select(KEY, TARGET)
    mapped = df.withColumn("mapped", class_index(F.col(TARGET)).cast("int"))
    mapped = mapped.withColumn("restored", index_class(F.col("mapped")))
    return replace_labels(mapped, {-1: 0, 0: 1, 1: 2}).withColumnRenamed(TARGET, "replaced")


@query("p8_keep_observed_rows", sql(f"SELECT {wholes('ID', 'day', 'equity', 'reod')} FROM kept"))
def p8(spark, sf_dir):
    return kept(spark, sf_dir).select(KEY, "day", "equity", TARGET)


P9_TRAIN = """good AS (SELECT pos FROM grid WHERE "ID" % 5 <> 0 GROUP BY pos HAVING avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) < 0.3)"""


@query(
    "p9_low_null_columns",
    sql(f"""SELECT CASE WHEN "ID" % 5 <> 0 THEN 'train' ELSE 'test' END AS side, {wholes('pos')}, count(*) AS n, {num('sum(coalesce(value, 0))', 'total')}
        FROM grid JOIN good USING (pos) GROUP BY ALL""", P9_TRAIN),
)
def p9(spark, sf_dir):
    train, test = I.low_null_columns(*train_test(spark, sf_dir))
    kept_columns = [c for c in RETURNS if c in train.columns]

    def long(df, side):
        return df.select(F.lit(side).alias("side"), F.explode(F.array(*[
            F.struct(F.lit(int(c[1:])).alias("pos"), F.col(c).alias("v")) for c in kept_columns
        ])).alias("e")) if kept_columns else df.select(F.lit(side).alias("side"), F.lit(None).cast("struct<pos:int,v:double>").alias("e")).where("false")

    both = long(train, "train").unionByName(long(test, "test"))
    return both.groupBy("side", F.col("e.pos").alias("pos")).agg(F.count(F.lit(1)).alias("n"), F.sum("e.v").alias("total"))


@query(
    "p10_zero_fill",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('coalesce(value, 0)', 'value')} FROM grid"),
)
def p10(spark, sf_dir):
    return packed(panel(spark, sf_dir).na.fill(0.0))


# --- joins --------------------------------------------------------------------------------------


@query(
    "j1_join_labels",
    sql(f'SELECT k."ID"::BIGINT AS "ID", k.day::BIGINT AS day, k.equity::BIGINT AS equity, lab.reod::BIGINT AS reod '
        'FROM keys k JOIN lab ON k."ID" = lab."ID" WHERE lab."ID" % 3 <> 0'),
)
def j1(spark, sf_dir):
    """Labels of two thirds of the keys: the inner join drops the rest."""
    from panelspark.sources.tables import join_labels

    df = panel(spark, sf_dir)
    labels = df.select(KEY, TARGET).where(F.col(KEY) % 3 != 0)
    return join_labels(df.select(KEY, "day", "equity"), labels)


@query(
    "j2_join_imputed_by_key",
    sql(f"SELECT {wholes('ID', 'day', 'equity', 'reod', 'pos')}, {nums('value')} FROM filled", f"filled AS ({mixed_fill('linear')})"),
)
def j2(spark, sf_dir):
    """Identifiers and imputed returns meet by key, never by position."""
    df = kept(spark, sf_dir)
    values = X.fill_rows(df.select(KEY, *RETURNS), "linear")
    joined = df.select(KEY, "day", "equity", TARGET).join(values, KEY)
    return packed(joined, ("day", "equity", TARGET))


# --- fills along a row --------------------------------------------------------------------------


def _fill_query(name: str, kind: str):
    @query(name, sql(f"SELECT {wholes('ID', 'pos')}, {nums('value')} FROM filled", f"filled AS ({mixed_fill(kind)})"))
    def run(spark, sf_dir):
        return packed(X.fill_rows(kept(spark, sf_dir), kind))


_fill_query("i1_forward_fill", "ffill")
_fill_query("i2_backward_fill", "bfill")
_fill_query("i3_forward_then_backward", "ffill_then_bfill")
_fill_query("i3_backward_then_forward", "bfill_then_ffill")
_fill_query("i4_linear_interpolation", "linear")


def _down_sql(kind: str) -> str:
    before = 'PARTITION BY equity, pos ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'
    after = 'PARTITION BY equity, pos ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING'
    prev, nxt = f"last_value(value IGNORE NULLS) OVER ({before})", f"first_value(value IGNORE NULLS) OVER ({after})"
    pp = f"last_value(CASE WHEN value IS NOT NULL THEN seq END IGNORE NULLS) OVER ({before})"
    pn = f"first_value(CASE WHEN value IS NOT NULL THEN seq END IGNORE NULLS) OVER ({after})"
    value = {
        "ffill": prev,
        "bfill": nxt,
        "ffill_then_bfill": f"coalesce({prev}, {nxt})",
        "bfill_then_ffill": f"coalesce({nxt}, {prev})",
        "linear": f"coalesce(value, {prev} + ({nxt} - {prev}) * (seq - {pp}) / ({pn} - {pp}), {prev}, {nxt})",
    }[kind]
    return sql(
        f"SELECT {wholes('ID', 'pos')}, {num(value, 'value')} FROM "
        "(SELECT *, row_number() OVER (PARTITION BY equity, pos ORDER BY day) AS seq FROM grid)"
    )


def _down_query(name: str, kind: str):
    @query(name, _down_sql(kind))
    def run(spark, sf_dir):
        columns = RETURNS
        df = panel(spark, sf_dir).select(KEY, "day", "equity", *columns)
        filled = I.fill_down(df, columns, ["equity"], "day", kind)
        return filled.select(KEY, F.posexplode(S.pack(columns)).alias("pos", "value"))


_down_query("i1_forward_fill_down", "ffill")
_down_query("i2_backward_fill_down", "bfill")
_down_query("i3_forward_then_backward_down", "ffill_then_bfill")
_down_query("i3_backward_then_forward_down", "bfill_then_ffill")
_down_query("i4_interpolation_down", "linear")

STATS = "stats AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM grid GROUP BY pos)"


@query(
    "i5_standardise",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('(value - m) / s', 'value')} FROM grid JOIN stats USING (pos)", STATS),
)
def i5(spark, sf_dir):
    scaled, _ = I.standardise(panel(spark, sf_dir), RETURNS)
    return packed(scaled)


@query("i6_inverse_standardise", sql(cells("panel")))
def i6(spark, sf_dir):
    return packed(I.inverse_standardise(*I.standardise(panel(spark, sf_dir), RETURNS)))


@query(
    "i10_mean_fill",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('coalesce(value, m)', 'value')} FROM grid JOIN stats USING (pos)", STATS),
)
def i10(spark, sf_dir):
    return packed(I.fill_with_statistic(panel(spark, sf_dir), RETURNS))


@query(
    "i10_median_fill",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('coalesce(value, q)', 'value')} FROM grid JOIN "
        "(SELECT pos, quantile_cont(value, 0.5) AS q FROM grid GROUP BY pos) USING (pos)"),
)
def i10_median(spark, sf_dir):
    return packed(I.fill_with_statistic(panel(spark, sf_dir), RETURNS, "median"))


# --- features -----------------------------------------------------------------------------------

BASIC = f"""avg(value) AS r_mean, stddev_samp(value) AS r_std, min(value) AS r_min, max(value) AS r_max,
 coalesce(sum(value), 0.0) AS r_sum, count(*) FILTER (value > 0) AS r_pos_count, count(*) FILTER (value < 0) AS r_neg_count,
 count(*) FILTER (value = 0) AS r_zero_count, coalesce(sum(value) FILTER (value > 0), 0.0) AS r_pos_sum,
 coalesce(sum(value) FILTER (value < 0), 0.0) AS r_neg_sum"""
ROLLING = ", ".join(
    f"CASE WHEN count(value) FILTER (pos >= {53 - w}) = {w} THEN avg(value) FILTER (pos >= {53 - w}) END AS r_roll_mean_{w}, "
    f"CASE WHEN count(value) FILTER (pos >= {53 - w}) = {w} THEN stddev_samp(value) FILTER (pos >= {53 - w}) END AS r_roll_std_{w}"
    for w in (5, 10, 20)
)
MOMENTUM = ", ".join(
    f"max(value) FILTER (pos = 52) - max(value) FILTER (pos = {52 - lag}) AS r_momentum_{lag}" for lag in (5, 10)
)
TECHNICAL = f"{ROLLING}, {MOMENTUM}"
FINANCIAL = ", ".join(
    [f"coalesce(stddev_samp(value) FILTER (pos < {w}), 0.0) AS volatility_{w}" for w in (10, 20, 30)]
    + [
        "coalesce(avg(value) FILTER (pos < 20) / (stddev_samp(value) FILTER (pos < 20) + 1e-8), 0.0) AS sharpe_ratio",
        "coalesce(avg(value) FILTER (pos >= 30 AND pos < 40) - avg(value) FILTER (pos >= 10 AND pos < 20), 0.0) AS momentum",
        "coalesce(CASE WHEN count(value) FILTER (pos < 30) > 1 THEN regr_slope(value, pos) FILTER (pos < 30) END, 0.0) AS trend_slope",
        "count(*) FILTER (value > 0) / 53.0 AS pos_ratio",
        "count(*) FILTER (value < 0) / 53.0 AS neg_ratio",
    ]
)
BASIC_FLOATS = ("r_mean", "r_std", "r_min", "r_max", "r_sum", "r_pos_sum", "r_neg_sum")
BASIC_COUNTS = ("r_pos_count", "r_neg_count", "r_zero_count")
TECHNICAL_NAMES = tuple(f"r_roll_{s}_{w}" for w in (5, 10, 20) for s in ("mean", "std")) + ("r_momentum_5", "r_momentum_10")
FINANCIAL_NAMES = ("volatility_10", "volatility_20", "volatility_30", "sharpe_ratio", "momentum", "trend_slope", "pos_ratio", "neg_ratio")


def feature_sql(aggregates: str, floats=(), counts=()) -> str:
    names = ", ".join(filter(None, [nums(*floats), wholes(*counts)]))
    return sql(f'SELECT {wholes("ID")}, {names} FROM (SELECT "ID", {aggregates} FROM grid GROUP BY "ID")')


@query("f0_add_features", feature_sql(f"{BASIC}, {TECHNICAL}", BASIC_FLOATS + TECHNICAL_NAMES, BASIC_COUNTS))
def f0(spark, sf_dir):
    return X.add_features(panel(spark, sf_dir)).drop("day", "equity", TARGET, *RETURNS)


@query("f1_f2_f3_basic_stats", feature_sql(BASIC, BASIC_FLOATS, BASIC_COUNTS))
def f1(spark, sf_dir):
    return X.add_features(panel(spark, sf_dir), ["basic_stats"]).drop("day", "equity", TARGET, *RETURNS)


@query("f4_f5_f6_technical", feature_sql(TECHNICAL, TECHNICAL_NAMES))
def f4(spark, sf_dir):
    return X.add_features(panel(spark, sf_dir), ["technical"]).drop("day", "equity", TARGET, *RETURNS)


@query("f7_f11_f12_financial_features", feature_sql(FINANCIAL, FINANCIAL_NAMES))
def f12(spark, sf_dir):
    return X.add_financial_features(panel(spark, sf_dir)).drop("day", "equity", TARGET, *RETURNS)


@query("f10_trend_slope", feature_sql(FINANCIAL, ("trend_slope",)))
def f10(spark, sf_dir):
    return X.add_financial_features(panel(spark, sf_dir)).select(KEY, "trend_slope")


P5_SQL = sql(
    f"SELECT {WIDE}, {nums(*FINANCIAL_NAMES)} FROM panel JOIN (SELECT \"ID\", {FINANCIAL} FROM grid GROUP BY \"ID\") f USING (\"ID\")"
)


@query("p4_select_returns_and_financial", P5_SQL)
def p4(spark, sf_dir):
    return X.select_returns_and_financial(X.add_financial_features(panel(spark, sf_dir)))


@query("p5_select_optimised", P5_SQL)
def p5(spark, sf_dir):
    return X.select_optimised(panel(spark, sf_dir))


# --- normalisation, gaps, paths -----------------------------------------------------------------

ROWSTAT = 'rowstat AS (SELECT "ID", avg(value) AS m, stddev_samp(value) AS s FROM grid GROUP BY "ID")'


@query(
    "n1_normalise_rows",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('coalesce((value - m) / (s + 1e-8), 0.0)', 'value')} FROM grid JOIN rowstat USING (\"ID\")", ROWSTAT),
)
def n1(spark, sf_dir):
    return packed(X.normalise_rows(panel(spark, sf_dir)))


@query(
    "n2_normalise_rows_plain",
    sql(
        f"SELECT {wholes('ID', 'pos')}, {num('(coalesce(value, 0) - m) / nullif(s, 0)', 'value')} FROM grid JOIN rowstat USING (\"ID\")",
        'rowstat AS (SELECT "ID", avg(coalesce(value, 0)) AS m, stddev_samp(coalesce(value, 0)) AS s FROM grid GROUP BY "ID")',
    ),
)
def n2(spark, sf_dir):
    return packed(X.normalise_rows_plain(panel(spark, sf_dir)))


@query(
    "f13_row_nulls",
    sql(f"SELECT {wholes('ID')}, 53 - count(value) AS null_count, {num('(53 - count(value)) * 100.0 / 53', 'null_percent')} FROM grid GROUP BY \"ID\""),
)
def f13(spark, sf_dir):
    return X.add_null_profile(panel(spark, sf_dir)).select(KEY, "null_count", "null_percent")


PATH = 'path AS (SELECT "ID", pos, coalesce(value, 0) AS x, sum(coalesce(value, 0)) OVER (PARTITION BY "ID" ORDER BY pos) AS p FROM grid)'


@query("f14_w2_price_path", sql(f"SELECT {wholes('ID', 'pos')}, {num('p', 'value')} FROM path", PATH))
def f14(spark, sf_dir):
    return X.add_price_path(panel(spark, sf_dir)).select(KEY, F.posexplode("path").alias("pos", "value"))


@query(
    "f15_w5_lead_lag",
    sql(f"SELECT {wholes('ID', 'pos')}, {num('x', 'x')}, {num('y', 'y')} FROM (SELECT \"ID\", pos, lead(p) OVER (PARTITION BY \"ID\" ORDER BY pos) AS x, p AS y FROM path) WHERE pos < 52", PATH),
)
def f15(spark, sf_dir):
    pairs = X.add_lead_lag(panel(spark, sf_dir)).select(KEY, F.posexplode("lead_lag").alias("pos", "e"))
    return pairs.select(KEY, "pos", "e.x", "e.y")


SIGNATURE_SQL = sql(
    f"""SELECT {wholes('ID')}, {nums('s1', 's2', 's11', 's12', 's21', 's22')}, {wholes('null_count')} FROM (
  SELECT "ID", sum(dx) AS s1, sum(dy) AS s2, sum(x0 * dx + dx * dx / 2) AS s11, sum(x0 * dy + dx * dy / 2) AS s12,
         sum(y0 * dx + dx * dy / 2) AS s21, sum(y0 * dy + dy * dy / 2) AS s22 FROM steps GROUP BY "ID")
  JOIN (SELECT "ID", 53 - count(value) AS null_count FROM grid GROUP BY "ID") USING ("ID")""",
    PATH + """, pts AS (SELECT "ID", pos, lead(p) OVER w AS x, p AS y FROM path WINDOW w AS (PARTITION BY "ID" ORDER BY pos)),
  steps AS (SELECT "ID", x - first_value(x) OVER w AS x0, y - first_value(y) OVER w AS y0,
                   lead(x) OVER w - x AS dx, lead(y) OVER w - y AS dy FROM pts WHERE pos < 52
            WINDOW w AS (PARTITION BY "ID" ORDER BY pos))""",
)


@query("f16_f17_j3_signature", SIGNATURE_SQL)
def f16(spark, sf_dir):
    return X.add_signature(panel(spark, sf_dir)).select(KEY, "s1", "s2", "s11", "s12", "s21", "s22", "null_count")


# --- long-form windows --------------------------------------------------------------------------


@query(
    "w1_trailing_frame",
    sql(f"""SELECT {wholes('ID', 'pos')}, {num('CASE WHEN n = 5 THEN m END', 'value')} FROM (
      SELECT "ID", pos, count(value) OVER w AS n, avg(value) OVER w AS m FROM grid
      WINDOW w AS (PARTITION BY "ID" ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""),
)
def w1(spark, sf_dir):
    """Rolling mean at every position, only over full windows."""
    df = panel(spark, sf_dir).withColumn("r", S.pack(RETURNS))
    mean = S.if_complete("slice(r, greatest(i - 3, 1), 5)", "v", f"{S.total('v')} / 5")
    return df.selectExpr(KEY, f"posexplode(transform(r, (x, i) -> if(i >= 4, {mean}, NULL))) AS (pos, value)")
