"""Quality rules as a short-circuit cascade.

A rule is a named condition that rejects a text. Each rule's cost (measured seconds over a bounded
sample) and selectivity (share of the sample that it rejects) are estimated first; the rules then run in
descending order of rejection per cost inside one CASE expression, so a text stops at the first rule that
rejects it. The order changes the work, never the verdict. SQL functions only; no shuffle on the main path.

Null text counts as empty: no words, rejected by the word count. Repeated rows are judged alike. An empty
table gives an empty result. Columns of the input are kept, whatever their names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import BLANKS, bind, free_name, text_of, words

SAMPLE_ROWS = 2000  # expected size of the sample that costs and selectivities come from
SYMBOLS = "#*$%&|<>"  # fixed values
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """Rejects where ``condition(metrics)`` is true; ``metrics`` maps the names in METRICS to columns."""

    name: str
    condition: object


BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
)
RULES = BASE_RULES + (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"])),
)


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows found twice or more.

    A text whose windows all have different hashes has none, which is seen in one pass. Otherwise windows are sorted
    as text with their place behind, so equal ones are neighbours: exact, and n log n whatever repeats.
    """
    hashes = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))
    windows = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2), F.lpad(i.cast("string"), 10, "0")),
    )).otherwise(F.array().cast("array<string>"))

    def starts(rows: Column) -> Column:
        return bind(F.transform(rows, lambda x: F.substring_index(x, " ", 3)), lambda key: F.sort_array(F.filter(
            F.transform(rows, lambda x, k: F.when(
                (F.get(key, k - 1) == F.get(key, k)) | (F.get(key, k + 1) == F.get(key, k)),
                F.substring_index(x, " ", -1).cast("long"))),
            lambda v: v.isNotNull())))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda x, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda total, v: total + v)

    exact = bind(F.sort_array(windows), lambda rows: bind(starts(rows), covered))
    different = bind(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(different, F.lit(0).cast("long")).otherwise(exact)


def metric_columns(text: Column, split: Column | None = None) -> dict[str, Column]:
    """The metrics as expressions over the text; each reads the whole text. ``split`` may name its words, if at hand."""
    split = words(text) if split is None else split
    bare = F.length(F.translate(text, BLANKS, ""))
    return {
        "n_words": F.size(split).cast("long"),
        "word_chars": bare.cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bind(_lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": bind(split, _repeat_words).cast("long"),
        "n_lines": F.size(_lines_with_words(text)).cast("long"),
    }


def estimate(df: DataFrame, rules, metrics, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds) for every rule, from a Bernoulli sample of about ``sample_rows`` rows."""
    total = df.count()
    if total == 0:
        return [(rule, 0.0, 1.0) for rule in rules]
    sample = df.sample(fraction=min(1.0, sample_rows / total), seed=7).persist()
    try:
        rows = sample.count()

        def timed(condition: Column) -> tuple[float, float]:
            begun = time.perf_counter()
            hits = sample.agg(F.count_if(condition)).first()[0]
            return hits / max(rows, 1), time.perf_counter() - begun

        timed(F.lit(False))
        idle = timed(F.lit(False))[1]
        found = []
        for rule in rules:
            share, seconds = timed(rule.condition(metrics))
            found.append((rule, share, max(seconds - idle, 1e-4)))
        return found
    finally:
        sample.unpersist()


def order(estimates) -> list[Rule]:
    """Most rejection per cost first; equal ones by name."""
    return [r for r, share, cost in sorted(estimates, key=lambda x: (-x[1] / x[2], x[0].name))]


def first_rejection(rules, metrics) -> Column:
    """Name of the first rule, in the given order, that rejects; null where none does."""
    result = F.lit(None).cast("string")
    for rule in reversed(rules):
        result = F.when(rule.condition(metrics), F.lit(rule.name)).otherwise(result)
    return result


def judge(df: DataFrame, text: str = "text", rules=RULES, metrics=None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with ``rejected_by``: the rule that rejected the row, null where it is kept.

    ``metrics`` may name columns that hold the metrics already; by default they are computed from ``text``, each
    only if the cascade comes that far.
    """
    metrics = metrics or metric_columns(text_of(text))
    ordered = order(estimate(df, rules, metrics, sample_rows))
    return df.withColumn(free_name(df, "rejected_by"), first_rejection(ordered, metrics))


def keep(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows that no rule rejects, with their columns."""
    name = free_name(df, "rejected_by")
    return judge(df, text, rules).filter(F.col(name).isNull()).drop(name)


def report(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """doc_id, the metrics, ``base_failed``, ``kept`` and ``rejected_by`` of every row."""
    split = df.select("doc_id", text_of(text).alias("t"), words(text_of(text)).alias("w"))
    measured = split.select("doc_id", *(c.alias(n) for n, c in metric_columns(F.col("t"), F.col("w")).items()))
    names = {n: F.col(n) for n in METRICS}
    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | rule.condition(names)
    # Costs and selectivities are those of the rules on texts, not on the columns just measured.
    ordered = order(estimate(df, rules, metric_columns(text_of(text))))
    return (
        measured.withColumn("base_failed", base)
        .withColumn("rejected_by", first_rejection(ordered, names))
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
    )
