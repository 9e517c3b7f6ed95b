"""Evaluation and result tables, on predictions of simple sign rules over whole datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import evaluate as E
from panelspark.operators import results as T
from panelspark.operators.features import add_features, add_financial_features, fill_rows
from panelspark.schema import KEY, TARGET
from workload.base import mixed_fill, num, nums, query, sql, stored_kept, whole, wholes

# rule: (feature, threshold of the cautious version)
RULES = {"sum_rule": ("r_sum", 100.0), "trend_rule": ("trend_slope", 0.5), "tail_rule": ("r_roll_mean_10", 5.0)}
BY = ["dataset", "model", "features_added"]


def predictions(spark, sf_dir) -> DataFrame:
    """(dataset, model, features_added, ID, actual, predicted). ``features_added`` marks the cautious version."""
    kept = stored_kept(spark, sf_dir)
    both = kept.select(F.lit("raw").alias("dataset"), "*").unionByName(
        fill_rows(kept, "ffill_then_bfill").select(F.lit("ffbf").alias("dataset"), "*")
    )
    featured = add_financial_features(add_features(both))
    votes = []
    for rule, (column, least) in RULES.items():
        x = F.coalesce(column, F.lit(0.0))
        sign = F.signum(x).cast("int")
        votes.append((rule, False, sign))
        votes.append((rule, True, F.when(F.abs(x) > least, sign).otherwise(0)))
    rows = F.explode(F.array(*[
        F.struct(F.lit(r).alias("model"), F.lit(f).alias("features_added"), v.alias("predicted")) for r, f, v in votes
    ])).alias("v")
    part = featured.select("dataset", KEY, F.col(TARGET).alias("actual"), rows)
    return part.select("dataset", "v.model", "v.features_added", KEY, "actual", "v.predicted")


def tracker(spark, sf_dir) -> DataFrame:
    """One result row per dataset, rule and version. The time stands in for a measured one."""
    results = E.classification_metrics(predictions(spark, sf_dir), BY)
    return results.withColumns({
        "dataset_description": F.concat(F.lit("dataset "), "dataset"),
        "normalize_by_row": F.lit(False),
        "total_time": F.length("model") + F.when(F.col("features_added"), 2.5).otherwise(1.0),
    })


def one_source(kind: str, key: str) -> str:
    return f"""SELECT '{key}' AS dataset, "ID", reod, coalesce(sum(value), 0) AS r_sum, coalesce(regr_slope(value, pos) FILTER (pos < 30), 0) AS trend_slope,
      CASE WHEN count(value) FILTER (pos >= 43) = 10 THEN avg(value) FILTER (pos >= 43) ELSE 0 END AS r_roll_mean_10
      FROM ({mixed_fill(kind)}) GROUP BY "ID", reod"""


PREDS = f"""src AS ({one_source('raw', 'raw')} UNION ALL {one_source('ffill_then_bfill', 'ffbf')}),
 preds AS (""" + " UNION ALL ".join(
    f"""SELECT dataset, '{rule}' AS model, {flag} AS features_added, "ID", reod AS actual, CAST({body} AS BIGINT) AS predicted FROM src"""
    for rule, (column, least) in RULES.items()
    for flag, body in (("false", f"sign({column})"), ("true", f"CASE WHEN abs({column}) > {least} THEN sign({column}) ELSE 0 END"))
) + """),
 cls AS (SELECT dataset, model, features_added, c AS class, count(*) FILTER (actual = c AND predicted = c) AS hits,
   count(*) FILTER (actual = c) AS support, count(*) FILTER (predicted = c) AS guesses
   FROM preds, (SELECT unnest([-1, 0, 1]) AS c) GROUP BY ALL),
 pr AS (SELECT *, coalesce(hits::DOUBLE / nullif(guesses, 0), 0) AS precision, coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall FROM cls WHERE support + guesses > 0),
 rep AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr),
 res AS (SELECT dataset, 'dataset ' || dataset AS dataset_description, model, features_added, false AS normalize_by_row,
   sum(hits) / sum(support) AS accuracy, length(model) + CASE WHEN features_added THEN 2.5 ELSE 1.0 END AS total_time, """ + ", ".join(
    f"avg({m}) AS {m}_macro, sum({m} * support) / sum(support) AS {m}_weighted" for m in ("precision", "recall", "f1")
) + ", " + ", ".join(
    f'coalesce(max({m}) FILTER (class = {c}), 0) AS "class_{c}_{m}"' for m in ("precision", "recall") for c in (-1, 0, 1)
) + " FROM rep GROUP BY ALL)"
METRICS = ["accuracy"] + [f"{m}_{k}" for m in ("precision", "recall", "f1") for k in ("macro", "weighted")] + [
    f"class_{c}_{m}" for m in ("precision", "recall") for c in (-1, 0, 1)
]


@query("v2_class_report", sql(f"SELECT dataset, model, features_added, {wholes('class', 'support', 'hits')}, {nums('precision', 'recall', 'f1')} FROM rep", PREDS))
def v2(spark, sf_dir):
    return E.class_report(E.confusion_counts(predictions(spark, sf_dir), BY), BY)


@query("v2_summary_metrics", sql(f"SELECT dataset, model, features_added, {nums(*METRICS)} FROM res", PREDS))
def v2_summary(spark, sf_dir):
    return E.classification_metrics(predictions(spark, sf_dir), BY)


def one_run(df: DataFrame) -> DataFrame:
    return df.where((F.col("dataset") == "ffbf") & (F.col("model") == "sum_rule") & F.col("features_added"))


ONE = "one AS (SELECT * FROM preds WHERE dataset = 'ffbf' AND model = 'sum_rule' AND features_added)"
COUNTS = ", ".join(whole(f"count(*) FILTER (predicted = {c})", str(c)) for c in (-1, 0, 1))
SHARES = ", ".join(num(f"count(*) FILTER (predicted = {c})::DOUBLE / count(*)", str(c)) for c in (-1, 0, 1))


@query("v3_confusion_matrix", sql(f"SELECT {wholes('actual')}, {COUNTS} FROM one GROUP BY actual", f"{PREDS}, {ONE}"))
def v3(spark, sf_dir):
    return E.confusion_matrix(one_run(predictions(spark, sf_dir)))


@query("v3_confusion_shares", sql(f"SELECT {wholes('actual')}, {SHARES} FROM one GROUP BY actual", f"{PREDS}, {ONE}"))
def v3_shares(spark, sf_dir):
    return E.confusion_matrix(one_run(predictions(spark, sf_dir)), normalise=True)


@query(
    "v2_v3_lineitem_rule",
    f"""WITH p AS (SELECT l_returnflag AS actual, CASE WHEN l_discount > 0.06 THEN 'R' WHEN l_quantity > 25 THEN 'A' ELSE 'N' END AS predicted FROM lineitem)
    SELECT actual, {", ".join(whole(f"count(*) FILTER (predicted = '{c}')", c) for c in "ANR")} FROM p GROUP BY actual""",
)
def v3_lineitem(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    guess = F.when(F.col("l_discount") > 0.06, "R").when(F.col("l_quantity") > 25, "A").otherwise("N")
    return E.confusion_matrix(lines.select(F.col("l_returnflag").alias("actual"), guess.alias("predicted")), ["A", "N", "R"])


@query("a21_prediction_shares", sql("SELECT CAST(c AS BIGINT) AS class, " + num("avg(CASE WHEN predicted = c THEN 1.0 ELSE 0 END)", "share") + " FROM one, (SELECT unnest([-1, 0, 1]) AS c) GROUP BY c", f"{PREDS}, {ONE}"))
def a21(spark, sf_dir):
    return E.prediction_shares(one_run(predictions(spark, sf_dir)))


SUMMARY = f"dataset, dataset_description, model, normalize_by_row, features_added, {nums('accuracy', 'f1_weighted', 'total_time')}"
TIES = ("dataset", "model", "features_added")


@query("v7_results_summary", sql(f"SELECT {SUMMARY} FROM res ORDER BY res.accuracy DESC, dataset, model, features_added LIMIT 10", PREDS))
def v7(spark, sf_dir):
    return T.results_summary(tracker(spark, sf_dir), 10, TIES)


GROUPED = ", ".join(num(f"{f}({c})", f"{c}_{k}") for c in ("accuracy", "f1_weighted") for k, f in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max")))


@query(
    "a15_group_summary",
    sql(f"SELECT dataset, model, {GROUPED}, {num('avg(total_time)', 'total_time_mean')}, {num('min(total_time)', 'total_time_min')} FROM "
        "(SELECT * FROM res ORDER BY accuracy DESC, dataset, model, features_added LIMIT 10) GROUP BY dataset, model", PREDS),
)
def a15(spark, sf_dir):
    """Over the best rows only, as in a summary of the top results."""
    return T.group_summary(T.top_results(tracker(spark, sf_dir), "accuracy", 10, TIES), ["dataset", "model"])


@query(
    "a16_best_pivot",
    sql("SELECT dataset, " + ", ".join(num(f"max(accuracy) FILTER (model = '{m}')", m) for m in RULES) + " FROM res GROUP BY dataset", PREDS),
)
def a16(spark, sf_dir):
    return T.best_pivot(tracker(spark, sf_dir), list(RULES))


@query("v8_t2_top_results", sql(f"SELECT {SUMMARY} FROM res ORDER BY res.f1_weighted DESC, dataset, model, features_added LIMIT 5", PREDS))
def v8(spark, sf_dir):
    return T.top_results(tracker(spark, sf_dir), "f1_weighted", 5, TIES).select(*T.SUMMARY_COLUMNS)


@query("t4_best_result", sql(f"SELECT {SUMMARY} FROM res ORDER BY res.accuracy DESC, dataset, model, features_added LIMIT 1", PREDS))
def t4(spark, sf_dir):
    return T.best_result(tracker(spark, sf_dir), ties=TIES).select(*T.SUMMARY_COLUMNS)


@query(
    "v9_improvements",
    sql(f"""SELECT dataset, model, {num('o.accuracy', 'without')}, {num('w.accuracy', 'with')}, {num('w.accuracy - o.accuracy', 'improvement')}
        FROM (SELECT * FROM res WHERE NOT features_added) o JOIN (SELECT * FROM res WHERE features_added) w USING (dataset, model)""", PREDS),
)
def v9(spark, sf_dir):
    return T.improvements(tracker(spark, sf_dir), "features_added", ["dataset", "model"])


@query("v10_mean_scores", sql(f"SELECT dataset, model, {num('avg(accuracy)', 'accuracy')} FROM res GROUP BY dataset, model", PREDS))
def v10(spark, sf_dir):
    return T.mean_scores(tracker(spark, sf_dir), ["dataset", "model"])


@query("p14_filter_results", sql(f"SELECT {SUMMARY} FROM res WHERE model = 'sum_rule' AND features_added", PREDS))
def p14(spark, sf_dir):
    results = tracker(spark, sf_dir)
    return results.where((F.col("model") == "sum_rule") & F.col("features_added")).select(*T.SUMMARY_COLUMNS)


@query(
    "u1_append_results",
    sql("SELECT dataset, model, features_added, " + num("accuracy", "accuracy") + ", CASE WHEN features_added THEN " + "round(f1_weighted + 3.7e-9, 6) + 0.0 END AS f1_weighted FROM res", PREDS),
)
def u1(spark, sf_dir):
    """The first half lacks a column that the second half has."""
    results = tracker(spark, sf_dir).select(*BY, "accuracy", "f1_weighted")
    return T.append_results(results.where(~F.col("features_added")).drop("f1_weighted"), results.where("features_added"))


@query("e11_best_method", sql(f"SELECT model AS method, {num('b', 'best_score')} FROM (SELECT model, max(accuracy) AS b FROM res GROUP BY model) ORDER BY b DESC, model LIMIT 1", PREDS))
def e11(spark, sf_dir):
    scores = tracker(spark, sf_dir).groupBy(F.col("model").alias("method")).agg(F.max("accuracy").alias("best_score"))
    return T.best_method(scores)
