"""Profiles, correlations, scalers, rankings."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import correlate as C
from panelspark.operators import profile as P
from panelspark.operators import rank as R
from panelspark.operators.evaluate import with_stratified_folds
from panelspark.operators.features import add_features, fill_rows, normalise_rows
from panelspark.operators.results import importance_share
from panelspark.operators.sampling import split_rows
from panelspark.operators.scale import fit_scaler
from panelspark.plans import findings as G
from panelspark.schema import KEY, TARGET
from panelspark.sources.derived import panel, split_by_key
from panelspark.sources.scratch import stored
from panelspark.sources.tables import sorted_output
from workload.base import RETURNS, mixed_fill, num, nums, packed, query, sql, stored_kept, stored_panel, whole, wholes
from workload.rows import BASIC, BASIC_COUNTS, BASIC_FLOATS, TECHNICAL, TECHNICAL_NAMES

CHOSEN = ["r0", "r10", "r25", "r40", "r52"]
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NAME = "'r' || pos AS \"column\""
FILLED = f"filled AS ({mixed_fill('ffill_then_bfill')})"
RAW = f"raw AS ({mixed_fill('raw')})"


def lineitem(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def strategies(spark, sf_dir) -> dict[str, DataFrame]:
    df = stored_kept(spark, sf_dir)
    return {"raw": df, "ffbf": fill_rows(df, "ffill_then_bfill")}


BOTH = f"{FILLED}, {RAW}, both_of AS (SELECT 'raw' AS strategy, * FROM raw UNION ALL SELECT 'ffbf', * FROM filled)"

# --- nulls and classes --------------------------------------------------------------------------


@query(
    "a1_a3_null_counts",
    sql(f"SELECT {NAME}, count(*) - count(value) AS null_count, {num('(count(*) - count(value)) * 100.0 / count(*)', 'null_percent')} FROM grid GROUP BY pos"),
)
def a1(spark, sf_dir):
    return P.null_counts(panel(spark, sf_dir), RETURNS)


@query(
    "a2_a4_table_size",
    sql(f"SELECT count(*) AS n_rows, 57::BIGINT AS n_columns, {whole('sum(53 - len(list_filter(r, lambda x: x IS NOT NULL)))', 'n_nulls')} FROM panel"),
)
def a2(spark, sf_dir):
    return P.table_size(panel(spark, sf_dir))


@query(
    "p11_null_bands",
    sql(f"""SELECT count(*) AS n_rows, count(*) FILTER (p > 0) AS any_null_rows, count(*) FILTER (p > 30) AS over_30_rows,
      count(*) FILTER (p > 50) AS over_50_rows, {num('count(*) FILTER (p > 0) * 100.0 / count(*)', 'any_null_percent')},
      {num('count(*) FILTER (p > 30) * 100.0 / count(*)', 'over_30_percent')}, {num('count(*) FILTER (p > 50) * 100.0 / count(*)', 'over_50_percent')}
      FROM (SELECT (53 - count(value)) * 100.0 / 53 AS p FROM grid GROUP BY "ID")"""),
)
def p11(spark, sf_dir):
    return P.null_bands(panel(spark, sf_dir))


@query(
    "a8_class_shares",
    sql(f"SELECT {whole('reod', 'class')}, count(*) AS n, {num('count(*) * 100.0 / sum(count(*)) OVER ()', 'percent')} FROM lab GROUP BY reod"),
)
def a8(spark, sf_dir):
    return P.class_shares(panel(spark, sf_dir))


@query("a23_distinct_labels", sql(f"SELECT DISTINCT {whole('reod', 'reod')} FROM lab"))
def a23(spark, sf_dir):
    return P.distinct_labels(panel(spark, sf_dir))


# --- statistics ---------------------------------------------------------------------------------

QUARTILES = ", ".join(num(f"quantile_cont(value, {q / 100})", f"q{q}") for q in (25, 50, 75))
DESCRIBE = f"""count(value) AS "count", {num('avg(value)', 'mean')}, {num('stddev_samp(value)', 'std')}, {num('min(value)', 'min')},
 {QUARTILES}, {num('max(value)', 'max')}"""


@query("a5_describe", sql(f"SELECT {NAME}, {DESCRIBE} FROM grid GROUP BY pos"))
def a5(spark, sf_dir):
    return P.describe(panel(spark, sf_dir), RETURNS)


LINE_LONG = "(SELECT unnest(['" + "', '".join(LINE) + "']) AS \"column\", unnest([" + ", ".join(LINE) + "]) AS value FROM lineitem)"


@query("a5_describe_lineitem", f'SELECT "column", {DESCRIBE} FROM {LINE_LONG} GROUP BY "column"')
def a5_line(spark, sf_dir):
    return P.describe(lineitem(spark, sf_dir), LINE)


MOMENTS = f"""{num('avg(value)', 'mean')}, {num('median(value)', 'median')}, {num('stddev_samp(value)', 'std')}, {num('min(value)', 'min')}, {num('max(value)', 'max')},
 {num('skewness(value)', 'skewness')}, {num('kurtosis(value)', 'kurtosis')}, {num('(count(*) - count(value)) * 100.0 / count(*)', 'missing_percent')}"""


@query("a6_column_stats", sql(f"SELECT strategy, {NAME}, {MOMENTS} FROM both_of GROUP BY strategy, pos", BOTH))
def a6(spark, sf_dir):
    return P.compare_column_stats(strategies(spark, sf_dir))


@query(
    "a7_pivot_statistic",
    sql(f"SELECT {NAME}, {num('avg(value) FILTER (strategy = ' + chr(39) + 'raw' + chr(39) + ')', 'raw')}, "
        f"{num('avg(value) FILTER (strategy = ' + chr(39) + 'ffbf' + chr(39) + ')', 'ffbf')} FROM both_of GROUP BY pos", BOTH),
)
def a7(spark, sf_dir):
    return P.pivot_statistic(P.compare_column_stats(strategies(spark, sf_dir)), "mean", ["raw", "ffbf"])


@query(
    "a9_quantiles",
    sql("SELECT " + NAME + ", " + ", ".join(num(f"quantile_cont(value, {q / 100})", f"q{q:02d}") for q in (1, 50, 99)) + " FROM grid GROUP BY pos"),
)
def a9(spark, sf_dir):
    from panelspark.functions.quantiles import column_quantiles

    cuts = column_quantiles(panel(spark, sf_dir), RETURNS, [0.01, 0.5, 0.99])
    return spark.createDataFrame([(c, *q) for c, q in cuts.items()], "column string, q01 double, q50 double, q99 double")


@query(
    "a9_quantiles_by_counting",
    "SELECT \"column\", " + ", ".join(num(f"quantile_cont(value, {q / 100})", f"q{q:02d}") for q in (1, 25, 50, 99)) + f' FROM {LINE_LONG} GROUP BY "column"',
)
def a9_counting(spark, sf_dir):
    """Raw numbers, four probabilities at once."""
    from panelspark.functions.quantiles import column_quantiles

    cuts = column_quantiles(lineitem(spark, sf_dir), LINE, [0.01, 0.25, 0.5, 0.99])
    return spark.createDataFrame([(c, *q) for c, q in cuts.items()], "column string, q01 double, q25 double, q50 double, q99 double")


@query(
    "p12_trim_outliers",
    sql(f"""SELECT {wholes('ID')}, {num('value', 'r0')} FROM grid, (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM grid WHERE pos = 0) q
        WHERE pos = 0 AND value BETWEEN a - 0.1 * (b - a) AND b + 0.1 * (b - a)""").replace("0.25", "0.01").replace("0.75", "0.99").replace("0.1 *", "-0.2 *"),
)
def p12(spark, sf_dir):
    """A negative reach, so that the cut removes something here."""
    return P.trim_outliers(panel(spark, sf_dir), "r0", reach=-0.2).select(KEY, "r0")


def histogram_sql(source: str, by: str, low: str = "TRUE") -> str:
    return f"""
 SELECT {by}, {whole('bin', 'bin')}, {num('lo + bin * (hi - lo) / 50', 'low')}, {num('lo + (bin + 1) * (hi - lo) / 50', 'high')}, count(*) AS n FROM (
   SELECT *, least(coalesce(floor((value - lo) / nullif((hi - lo) / 50, 0)), 0), 49) AS bin FROM (
     SELECT *, min(value) OVER (PARTITION BY {by}) AS lo, max(value) OVER (PARTITION BY {by}) AS hi
     FROM {source} WHERE value IS NOT NULL AND {low})) GROUP BY {by}, bin, lo, hi"""


@query("a17_histograms", histogram_sql(LINE_LONG, '"column"'))
def a17(spark, sf_dir):
    return P.histograms(lineitem(spark, sf_dir), LINE)


CHOSEN_LONG = f"chosen AS (SELECT strategy, {NAME}, value FROM both_of WHERE pos IN (0, 10, 25, 40, 52))"


@query(
    "a19_distribution_stats",
    sql(f"""SELECT strategy, "column", {num('avg(value)', 'mean')}, {num('median(value)', 'median')}, {num('stddev_samp(value)', 'std')},
        {num('(count(*) - count(value)) * 100.0 / count(*)', 'missing_percent')} FROM chosen GROUP BY ALL""", f"{BOTH}, {CHOSEN_LONG}"),
)
def a19(spark, sf_dir):
    return P.distribution_report(strategies(spark, sf_dir), CHOSEN)[0]


@query(
    "a19_distribution_histograms",
    sql(
        "SELECT * EXCLUDE k, split_part(k, '/', 1) AS strategy, split_part(k, '/', 2) AS \"column\" FROM ("
        + histogram_sql("inside", "k") + ")",
        f"""{BOTH}, {CHOSEN_LONG}, cuts AS (SELECT strategy, "column", quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM chosen GROUP BY ALL),
        inside AS (SELECT strategy || '/' || "column" AS k, value FROM chosen JOIN cuts USING (strategy, "column")
                   WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a))""",
    ),
)
def a19_histograms(spark, sf_dir):
    return P.distribution_report(strategies(spark, sf_dir), CHOSEN)[1]


# --- correlations -------------------------------------------------------------------------------

ZERO = "zero AS (SELECT \"ID\", pos, coalesce(value, 0) AS value FROM grid)"
MATRIX = "matrix AS (SELECT a.pos AS i, b.pos AS j, corr(a.value, b.value) AS c FROM zero a JOIN zero b USING (\"ID\") GROUP BY ALL)"
PAIR = "'r' || i AS var1, 'r' || j AS var2"


@query("a10_correlation_matrix", sql(f"SELECT {PAIR}, {num('c', 'corr')} FROM matrix", f"{ZERO}, {MATRIX}"))
def a10(spark, sf_dir):
    return C.correlation_matrix(panel(spark, sf_dir), RETURNS, fill=0.0)


def pairwise_sql(source: str) -> str:
    return f"""SELECT a.pos AS i, b.pos AS j, corr(a.value, b.value) AS c FROM {source} a JOIN {source} b USING ("ID") GROUP BY ALL"""


@query("a10_correlation_pairwise", sql(f"SELECT {PAIR}, {num('c', 'corr')} FROM ({pairwise_sql('grid')})"))
def a10_pairwise(spark, sf_dir):
    return C.correlation_matrix(panel(spark, sf_dir), RETURNS)


@query(
    "a10_correlation_lineitem",
    "SELECT a AS var1, b AS var2, " + num("c", "corr") + " FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c FROM lineitem" for a in LINE for b in LINE) + ")",
)
def a10_line(spark, sf_dir):
    return C.correlation_matrix(lineitem(spark, sf_dir), LINE)


TARGET_CORR = "tc AS (SELECT pos, corr(value, reod) AS c FROM grid JOIN lab USING (\"ID\") GROUP BY pos)"


@query("a11_target_correlations", sql(f"SELECT {NAME}, {num('c', 'corr')} FROM tc", TARGET_CORR))
def a11(spark, sf_dir):
    return C.target_correlations(panel(spark, sf_dir), RETURNS)


@query("a12_strong_pairs", sql(f"SELECT {PAIR}, {num('c', 'corr')} FROM matrix WHERE i < j AND abs(c) > 0.1", f"{ZERO}, {MATRIX}"))
def a12(spark, sf_dir):
    return C.strong_pairs(C.correlation_matrix(panel(spark, sf_dir), RETURNS, fill=0.0), RETURNS, 0.1)


NORMED = """normed AS (SELECT "ID", pos, coalesce((value - m) / (s + 1e-8), 0.0) AS value FROM grid JOIN
 (SELECT "ID", avg(value) AS m, stddev_samp(value) AS s FROM grid GROUP BY "ID") USING ("ID"))"""


@query(
    "a13_normalisation_impact",
    sql(f"SELECT {PAIR}, {num('n.c - o.c', 'change')} FROM ({pairwise_sql('grid')}) o JOIN ({pairwise_sql('normed')}) n USING (i, j)", NORMED),
)
def a13(spark, sf_dir):
    df = panel(spark, sf_dir)
    return C.normalisation_impact(df, normalise_rows(df), RETURNS)


EXTREMES = """(SELECT * FROM (SELECT 'top' AS side, c, pos FROM {t} WHERE c IS NOT NULL ORDER BY c DESC LIMIT {n})
 UNION ALL SELECT * FROM (SELECT 'bottom' AS side, c, pos FROM {t} WHERE c IS NOT NULL ORDER BY c LIMIT {n}))"""


@query(
    "a14_t3_target_extremes",
    sql(f"SELECT side, {NAME}, {num('c', 'corr')} FROM {EXTREMES.format(t='zc', n=10)}",
        f"{ZERO}, zc AS (SELECT pos, corr(value, reod) AS c FROM zero JOIN lab USING (\"ID\") GROUP BY pos)"),
)
def a14(spark, sf_dir):
    return C.correlation_report(panel(spark, sf_dir))["target_extremes"]


# --- feature groups and normalisations ----------------------------------------------------------

def spread_sql(c: str, name: str) -> str:
    return ", ".join(num(f"{f}({c})", f"{name}_{k}") for k, f in
                     (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("median", "median"), ("max", "max")))


# Long cells of the filled panel and its features, by group of columns.
FEATURE_NAMES = (*BASIC_FLOATS, *BASIC_COUNTS, *TECHNICAL_NAMES)
GROUPED = f"""{FILLED}, feats AS (SELECT "ID", {BASIC}, {TECHNICAL} FROM filled GROUP BY "ID"),
 wide AS (SELECT "ID", {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_NAMES)} FROM feats),
 cells AS (SELECT 'returns' AS "group", 'r' || pos AS "column", "ID", reod, CAST(value AS DOUBLE) AS value FROM filled
   UNION ALL SELECT CASE WHEN name LIKE '%roll%' THEN 'rolling' WHEN name LIKE '%momentum%' THEN 'momentum' ELSE 'basic_stats' END, name, "ID", reod, value
   FROM (FROM wide UNPIVOT INCLUDE NULLS (value FOR name IN ({", ".join(FEATURE_NAMES)}))) JOIN lab USING ("ID"))"""
COLSTAT = """cs AS (SELECT "group", "column", avg(value) AS m, stddev_samp(value) AS s, count(*) - count(value) AS missing, corr(value, reod) AS c FROM cells GROUP BY ALL)"""


def grouped(spark, sf_dir) -> DataFrame:
    return stored(add_features(fill_rows(stored_kept(spark, sf_dir), "ffill_then_bfill")), "grouped")


@query(
    "a18_group_profile",
    sql(f"""SELECT "group", count(*) AS n_features, {whole('sum(missing)', 'missing')}, {spread_sql('m', 'mean')}, {spread_sql('s', 'std')} FROM cs GROUP BY "group\"""",
        f"{GROUPED}, {COLSTAT}"),
)
def a18(spark, sf_dir):
    return G.group_profile(grouped(spark, sf_dir))["stats"]


@query("a18_group_target", sql(f"""SELECT "group", {num('avg(abs(c)) FILTER (NOT isnan(c))', 'mean_abs_corr')} FROM cs GROUP BY "group\"""", f"{GROUPED}, {COLSTAT}"))
def a18_target(spark, sf_dir):
    return G.group_profile(grouped(spark, sf_dir))["target"]


@query(
    "a18_group_extremes",
    sql(f"""SELECT "group", side, "column", {num('c', 'corr')} FROM (
      SELECT *, 'top' AS side, row_number() OVER (PARTITION BY "group" ORDER BY c DESC, "column") AS k FROM cs WHERE c IS NOT NULL AND NOT isnan(c)
      UNION ALL SELECT *, 'bottom', row_number() OVER (PARTITION BY "group" ORDER BY c, "column") FROM cs WHERE c IS NOT NULL AND NOT isnan(c)) WHERE k <= 3""",
        f"{GROUPED}, {COLSTAT}"),
)
def a18_extremes(spark, sf_dir):
    return G.group_profile(grouped(spark, sf_dir))["target_extremes"]


@query(
    "a18_group_correlations",
    sql(f"""SELECT a."group", a."column" AS var1, b."column" AS var2, {num('corr(a.value, b.value)', 'corr')} FROM cells a JOIN cells b USING ("group", "ID") GROUP BY ALL""", GROUPED),
)
def a18_inner(spark, sf_dir):
    return G.group_profile(grouped(spark, sf_dir))["inner"]


VERSIONS = f"""fz AS (SELECT "ID", pos, coalesce(value, 0) AS value FROM raw),
 col AS (SELECT pos, avg(value) AS m, stddev_pop(value) AS s, quantile_cont(value, 0.25) AS a, median(value) AS q, quantile_cont(value, 0.75) AS b FROM fz GROUP BY pos),
 row_ AS (SELECT "ID", avg(value) AS m, stddev_samp(value) AS s FROM fz GROUP BY "ID"),
 versions AS (SELECT 'original' AS method, "ID", pos, value FROM fz
   UNION ALL SELECT 'standard', "ID", pos, (value - m) / CASE WHEN s = 0 THEN 1 ELSE s END FROM fz JOIN col USING (pos)
   UNION ALL SELECT 'robust', "ID", pos, (value - q) / CASE WHEN b - a = 0 THEN 1 ELSE b - a END FROM fz JOIN col USING (pos)
   UNION ALL SELECT 'row', fz."ID", pos, (value - m) / nullif(s, 0) FROM fz JOIN row_ ON row_."ID" = fz."ID")"""
EXACT_METHODS = ["original", "standard", "robust", "row"]
FIVE = f"""{num('avg(value)', 'mean')}, {num('median(value)', 'median')}, {num('stddev_samp(value)', 'std')}, {num('skewness(value)', 'skewness')}, {num('kurtosis(value)', 'kurtosis')}"""
NORM_STATS = sql(f"SELECT method, {NAME}, {FIVE} FROM versions WHERE pos IN (0, 10, 25, 40, 52) GROUP BY method, pos", f"{RAW}, {VERSIONS}")


@query("a20_compare_normalisations", NORM_STATS)
def a20(spark, sf_dir):
    return G.compare_normalisations(stored_kept(spark, sf_dir), CHOSEN, EXACT_METHODS)


@query("a20_c4_quantile_normalisation")
def a20_quantile(spark, sf_dir):
    return G.compare_normalisations(stored_kept(spark, sf_dir), CHOSEN, ["quantile"])


@query(
    "a16b_pivot_normalisations",
    sql("SELECT " + NAME + ", " + ", ".join(
        num(f"{f}(value) FILTER (method = '{m}')", f"{m}_{k}") for m in EXACT_METHODS
        for k, f in (("mean", "avg"), ("std", "stddev_samp"), ("skewness", "skewness"), ("kurtosis", "kurtosis"))
    ) + " FROM versions WHERE pos IN (0, 10, 25, 40, 52) GROUP BY pos", f"{RAW}, {VERSIONS}"),
)
def a16b(spark, sf_dir):
    stats = G.compare_normalisations(stored_kept(spark, sf_dir), CHOSEN, EXACT_METHODS)
    return G.pivot_normalisations(stats, EXACT_METHODS)


# --- scalers ------------------------------------------------------------------------------------

FITTED = """fit AS (SELECT pos, avg(v) AS m, stddev_pop(v) AS s, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.25) AS a, median(v) AS q, quantile_cont(v, 0.75) AS b
 FROM (SELECT pos, coalesce(value, 0) AS v FROM grid WHERE "ID" % 5 <> 0) GROUP BY pos), tst AS (SELECT "ID", pos, coalesce(value, 0) AS v FROM grid WHERE "ID" % 5 = 0)"""


def _scaler_query(name: str, kind: str, centre: str, scale: str):
    expression = f"(v - {centre}) / CASE WHEN {scale} = 0 THEN 1 ELSE {scale} END"

    @query(name, sql(f"SELECT {wholes('ID', 'pos')}, {num(expression, 'value')} FROM tst JOIN fit USING (pos)", FITTED))
    def run(spark, sf_dir):
        """Fitted on the training keys, applied to the test keys."""
        train, test = (df.na.fill(0.0, RETURNS) for df in split_by_key(stored_panel(spark, sf_dir)))
        return packed(fit_scaler(kind, train, RETURNS).transform(test))


_scaler_query("c1_standard_scaler", "standard", "m", "s")
_scaler_query("c2_minmax_scaler", "minmax", "lo", "(hi - lo)")
_scaler_query("c3_robust_scaler", "robust", "q", "(b - a)")


@query("c4_quantile_scaler")
def c4(spark, sf_dir):
    train, test = (df.na.fill(0.0, RETURNS) for df in split_by_key(stored_panel(spark, sf_dir)))
    return packed(fit_scaler("quantile", train, RETURNS).transform(test))


# --- rankings -----------------------------------------------------------------------------------

FEATURE = "'r' || pos AS feature"
RANKED = "row_number() OVER (ORDER BY round(score, 12) DESC NULLS LAST, 'r' || pos)"


def ranked_sql(method: str, source: str, extra: str = "", where: str = "") -> str:
    return (f"SELECT '{method}' AS method, {FEATURE}, {num('score', 'score')}, {extra} {whole('rank', 'rank')} FROM "
            f"(SELECT *, {RANKED} AS rank FROM {source}) {where}")


CORR_SCORE = TARGET_CORR + ", by_corr AS (SELECT pos, c, abs(c) AS score FROM tc)"


@query("e1_p13_important_features", sql(ranked_sql("correlation", "by_corr", num("c", "corr") + ",", "WHERE score > 0.05"), CORR_SCORE))
def e1(spark, sf_dir):
    return R.important_features(panel(spark, sf_dir), RETURNS)


@query("e2_rank_by_correlation", sql(ranked_sql("correlation", "by_corr", num("c", "corr") + ",", "WHERE rank <= 20"), CORR_SCORE))
def e2(spark, sf_dir):
    return R.rank_by_correlation(panel(spark, sf_dir), RETURNS, top_n=20)


F_SCORE = """per AS (SELECT pos, reod, count(value) AS n, avg(value) AS m, var_pop(value) AS v FROM grid JOIN lab USING ("ID") WHERE value IS NOT NULL GROUP BY pos, reod),
 grand AS (SELECT pos, sum(n * m) / sum(n) AS g, sum(n) AS nn, count(*) AS k FROM per GROUP BY pos),
 by_f AS (SELECT pos, (sum(n * (m - g) ** 2) / (max(k) - 1)) / (sum(n * v) / (max(nn) - max(k))) AS score, max(nn) - max(k) AS d2 FROM per JOIN grand USING (pos) GROUP BY pos)"""


@query("e3_rank_by_f_value", sql(ranked_sql("f_value", "by_f", num("pow(1 + 2 * score / d2, -d2 / 2)", "p_value") + ","), F_SCORE))
def e3(spark, sf_dir):
    """With three classes the tail of F(2, d) has a closed form, which the SQL uses."""
    return R.rank_by_f_value(panel(spark, sf_dir), RETURNS)


MI_SCORE = """cuts AS (SELECT pos, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM grid GROUP BY pos),
 cells AS (SELECT pos, len(list_filter(list_distinct(e), lambda x: x < value)) AS cell, reod, count(*) AS n FROM grid JOIN cuts USING (pos) JOIN lab USING ("ID")
   WHERE value IS NOT NULL GROUP BY ALL),
 joint_ AS (SELECT *, sum(n) OVER (PARTITION BY pos) AS na, sum(n) OVER (PARTITION BY pos, cell) AS nc, sum(n) OVER (PARTITION BY pos, reod) AS nr FROM cells),
 by_mi AS (SELECT pos, sum(n / na * ln(n * na / (nc * nr))) AS score FROM joint_ GROUP BY pos)"""


@query("e4_rank_by_mutual_information", sql(ranked_sql("mutual_info", "by_mi"), MI_SCORE))
def e4(spark, sf_dir):
    return R.rank_by_mutual_information(panel(spark, sf_dir), RETURNS)


NEAR_SCORE = """v AS (SELECT pos, reod, "ID", value FROM grid JOIN lab USING ("ID") WHERE value IS NOT NULL),
 u AS (SELECT *, count(*) OVER (PARTITION BY pos, reod) AS nc FROM v QUALIFY nc > 1),
 d AS (SELECT a.pos, a."ID", a.value, a.nc, list_sort(list(abs(b.value - a.value)))[least(3, a.nc - 1)] AS r
   FROM u a JOIN u b ON a.pos = b.pos AND a.reod = b.reod AND a."ID" <> b."ID" GROUP BY a.pos, a."ID", a.value, a.nc),
 m AS (SELECT d.pos, d."ID", d.nc, count(*) AS m FROM d JOIN u b ON b.pos = d.pos AND (abs(b.value - d.value) < d.r OR b.value = d.value) GROUP BY ALL),
 h AS (SELECT n, coalesce(sum(1 / (n - 1)) FILTER (n > 1) OVER (ORDER BY n), 0) AS psi FROM (SELECT CAST(unnest(range(1, (SELECT count(*) + 2 FROM lab))) AS DOUBLE) AS n)),
 by_near AS (SELECT pos, greatest((SELECT psi FROM h WHERE n = whole) + mean, 0) AS score FROM (
   SELECT m.pos, count(*) AS whole, avg(hk.psi - hc.psi - hm.psi) AS mean FROM m JOIN h hk ON hk.n = least(3, m.nc - 1) JOIN h hc ON hc.n = m.nc JOIN h hm ON hm.n = m.m GROUP BY m.pos))"""


@query("e4_nearest_mutual_information", sql(ranked_sql("mutual_info", "by_near"), NEAR_SCORE))
def e4_nearest(spark, sf_dir):
    """The estimate of the nearest neighbours, three of them."""
    return R.rank_by_nearest_information(stored_panel(spark, sf_dir), RETURNS)


@query("e10_fallback_top_correlated", sql(f"SELECT {FEATURE}, {whole('rank', 'rank')} FROM (SELECT *, {RANKED} AS rank FROM by_corr) WHERE rank <= 20", CORR_SCORE))
def e10(spark, sf_dir):
    return R.rank_by_correlation(panel(spark, sf_dir), RETURNS, top_n=20).select("feature", "rank")


THREE = f"{CORR_SCORE}, {F_SCORE}, {MI_SCORE}, ranks AS (SELECT 'correlation' AS method, {FEATURE}, {RANKED} AS rank FROM by_corr " \
        f"UNION ALL SELECT 'f_value', {FEATURE}, {RANKED} FROM by_f UNION ALL SELECT 'mutual_info', {FEATURE}, {RANKED} FROM by_mi)"
METHODS = ["correlation", "f_value", "mutual_info"]


def three_rankings(spark, sf_dir) -> DataFrame:
    from panelspark.plans.selection import rank_all

    return rank_all(stored_panel(spark, sf_dir), RETURNS)


@query(
    "u5_rankings_side_by_side",
    sql("SELECT " + whole("rank", "rank") + ", " + ", ".join(f"max(feature) FILTER (method = '{m}') AS {m}" for m in METHODS) + " FROM ranks WHERE rank <= 20 GROUP BY rank", THREE),
)
def u5(spark, sf_dir):
    return R.side_by_side(three_rankings(spark, sf_dir), METHODS)


@query(
    "e5_u5_ranking_overlaps",
    sql(f"""SELECT a.method AS method1, b.method AS method2, {whole('len(list_intersect(a.f, b.f))', 'overlap_count')},
        {num('len(list_intersect(a.f, b.f)) * 100.0 / 20', 'overlap_percent')}, list_aggregate(list_sort(list_intersect(a.f, b.f)), 'string_agg', ',') AS common
        FROM l a JOIN l b ON a.method < b.method""", f"{THREE}, l AS (SELECT method, list(feature) AS f FROM ranks WHERE rank <= 20 GROUP BY method)"),
)
def e5(spark, sf_dir):
    return R.pair_overlaps(three_rankings(spark, sf_dir))


@query("u2_common_features", sql("SELECT feature FROM ranks WHERE rank <= 20 GROUP BY feature HAVING count(DISTINCT method) = 3", THREE))
def u2(spark, sf_dir):
    return R.common_features(three_rankings(spark, sf_dir), 3)


@query("u3_union_features", sql("SELECT DISTINCT feature FROM ranks WHERE rank <= 10", THREE))
def u3(spark, sf_dir):
    return R.union_features(three_rankings(spark, sf_dir))


# F scores as shares of their sum stand in for importances here.
IMPORTANCE = F_SCORE + ", imp AS (SELECT pos, score / sum(score) OVER () AS importance FROM by_f)"


def score_shares(spark, sf_dir) -> DataFrame:
    from pyspark.sql import Window as W

    scores = R.anova_scores(panel(spark, sf_dir), RETURNS)
    return scores.select("feature", (F.col("score") / F.sum("score").over(W.partitionBy())).alias("importance"))


@query("e6_best_features", sql(f"SELECT {FEATURE}, {nums('importance')} FROM imp WHERE importance > 0.01 ORDER BY importance DESC LIMIT 20", IMPORTANCE))
def e6(spark, sf_dir):
    return R.best_features(score_shares(spark, sf_dir))


@query("a24_importance_share", sql(f"SELECT {num('sum(importance)', 'importance')} FROM (SELECT importance FROM imp ORDER BY importance DESC LIMIT 10)", IMPORTANCE))
def a24(spark, sf_dir):
    return importance_share(score_shares(spark, sf_dir))


# Mean squares as shares of their sum: a cumulative curve over columns.
CURVE = """curve AS (SELECT pos + 1 AS component, ratio, sum(ratio) OVER (ORDER BY pos) AS cumulative FROM (
 SELECT pos, avg(value * value) / sum(avg(value * value)) OVER () AS ratio FROM grid GROUP BY pos))"""


@query(
    "w4_components_needed",
    sql(f"SELECT {num('t', 'threshold')}, {whole('min(component) FILTER (cumulative >= t)', 'components')} FROM curve, (SELECT unnest([0.7, 0.8, 0.9, 0.95, 1.5]) AS t) GROUP BY t", CURVE),
)
def w4(spark, sf_dir):
    """The last threshold is out of reach and gives NULL."""
    from pyspark.sql import Window as W

    from panelspark.operators.reduce import components_needed, running_total

    share = P.long_values(panel(spark, sf_dir), RETURNS).groupBy("pos").agg(F.avg(F.col("value") * F.col("value")).alias("m"))
    curve = share.select((F.col("pos") + 1).alias("component"), (F.col("m") / F.sum("m").over(W.partitionBy())).alias("ratio"))
    return components_needed(curve.withColumn("cumulative", running_total("ratio", "component")), (0.7, 0.8, 0.9, 0.95, 1.5))


@query(
    "e9_findings",
    sql(f"""SELECT 'strong pairs' AS section, 'count' AS key, CAST(count(*) AS VARCHAR) AS value FROM matrix WHERE i < j AND abs(c) > 0.1
      UNION ALL SELECT * FROM (SELECT 'strong pairs', 'r' || i || ' / r' || j, printf('%.4f', c) FROM matrix WHERE i < j AND abs(c) > 0.1 ORDER BY abs(c) DESC LIMIT 3)
      UNION ALL SELECT 'target', side || ' r' || pos, printf('%.4f', c) FROM {EXTREMES.format(t='tc', n=3)}
      UNION ALL SELECT * FROM (SELECT 'importance', 'r' || pos, printf('%.4f', importance) FROM imp ORDER BY importance DESC LIMIT 5)
      UNION ALL SELECT 'importance', 'top 10 share', printf('%.4f', sum(importance)) FROM (SELECT importance FROM imp ORDER BY importance DESC LIMIT 10)
      UNION ALL SELECT 'components', CAST(t AS VARCHAR), CAST(min(component) FILTER (cumulative >= t) AS VARCHAR) FROM curve, (SELECT unnest([0.7::DOUBLE, 0.8, 0.9, 0.95]) AS t) GROUP BY t""",
        f"{ZERO}, {MATRIX}, {TARGET_CORR}, {IMPORTANCE}, {CURVE}"),
)
def e9(spark, sf_dir):
    """The table with a curve of mean squares and F shares, which SQL can give; ``e9_findings_of_models`` has fitted ones."""
    from pyspark.sql import Window as W

    from panelspark.operators.reduce import running_total

    df = stored_panel(spark, sf_dir)
    share = P.long_values(df, RETURNS).groupBy("pos").agg(F.avg(F.col("value") * F.col("value")).alias("m"))
    curve = share.select((F.col("pos") + 1).alias("component"), (F.col("m") / F.sum("m").over(W.partitionBy())).alias("ratio"))
    strong = C.strong_pairs(C.correlation_matrix(df, RETURNS, fill=0.0), RETURNS, 0.1)
    return G.findings(
        curve.withColumn("cumulative", running_total("ratio", "component")), None, strong,
        C.target_correlations(df, RETURNS), score_shares(spark, sf_dir),
    )


# --- order and splits ---------------------------------------------------------------------------

HASH = "CAST('0x' || left(md5('42:' || CAST(\"ID\" AS VARCHAR)), 8) AS BIGINT) / 4294967296.0"


@query("t1_sorted_output", sql(f"SELECT {wholes('ID', 'day', 'equity', 'reod')} FROM panel ORDER BY \"ID\""))
def t1(spark, sf_dir):
    return sorted_output(panel(spark, sf_dir).select(KEY, "day", "equity", TARGET))


@query("t5_sample_rows", sql(f"SELECT {wholes('ID')}, u FROM (SELECT \"ID\", round({HASH}, 9) AS u FROM keys) ORDER BY u, \"ID\" LIMIT 50").replace(", u FROM (SELECT", " FROM (SELECT"))
def t5(spark, sf_dir):
    from panelspark.operators.sampling import sample_rows

    return sample_rows(panel(spark, sf_dir), 50).select(KEY)


@query("t7_split_rows", sql(f"SELECT CASE WHEN {HASH} < 0.8 THEN 'train' ELSE 'validation' END AS part, {wholes('ID')} FROM keys"))
def t7(spark, sf_dir):
    train, validation = split_rows(panel(spark, sf_dir).select(KEY))
    return train.select(F.lit("train").alias("part"), KEY).unionByName(validation.select(F.lit("validation").alias("part"), KEY))


@query("v4_stratified_folds", sql(
    "SELECT fold, reod, n FROM (SELECT fold, reod, CAST((n + 4 - fold) // 5 AS BIGINT) AS n FROM "
    "(SELECT CAST(reod AS BIGINT) AS reod, count(*) AS n FROM lab GROUP BY ALL), (SELECT unnest(range(5)) AS fold)) WHERE n > 0"))
def v4_stratified(spark, sf_dir):
    folded = with_stratified_folds(stored_panel(spark, sf_dir), 5, TARGET)
    return folded.groupBy("fold", TARGET).agg(F.count(F.lit(1)).alias("n"))


@query("v4_fold_balance", sql(f"SELECT {whole(f'floor({HASH} * 5)', 'fold')}, {whole('reod', 'reod')}, count(*) AS n FROM lab GROUP BY ALL"))
def v4_folds(spark, sf_dir):
    from panelspark.operators.evaluate import with_folds

    return with_folds(panel(spark, sf_dir)).groupBy("fold", TARGET).agg(F.count(F.lit(1)).alias("n"))
