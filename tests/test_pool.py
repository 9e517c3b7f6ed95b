"""Work side by side and stratified folds."""

import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelspark.operators.evaluate import with_stratified_folds
from panelspark.operators.pool import side_by_side


def test_results_keep_their_order_and_run_together(spark):
    running, most, lock = 0, 0, threading.Lock()

    def piece(i):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.3)
        n = spark.range(i).count()
        with lock:
            running -= 1
        return n

    assert side_by_side(spark, [lambda i=i: piece(i) for i in range(9)], 3) == list(range(9))
    assert most == 3
    assert side_by_side(spark, []) == [] and side_by_side(spark, [lambda: 5]) == [5]


def test_a_failure_ends_the_others(spark):
    def slow():
        return spark.range(4, numPartitions=4).select(F.expr("java_method('java.lang.Thread', 'sleep', 30000L)")).collect()

    def fails():
        time.sleep(1)
        raise KeyError("this one")

    started = time.perf_counter()
    with pytest.raises(KeyError):
        side_by_side(spark, [slow, fails], 2)
    assert time.perf_counter() - started < 25


def test_folds_are_stratified(spark):
    rows = [(i, None if i % 11 == 0 else i % 3 if i < 90 else 0) for i in range(200)] + [(7, 1), (7, 1)]
    df = spark.createDataFrame(rows, "ID long, label int").withColumn("hashed", F.lit(1))
    folded = with_stratified_folds(df.repartition(6), 4)
    assert folded.columns == [*df.columns, "fold"]
    counts = Counter((r["label"], r["fold"]) for r in folded.collect())
    for c in (None, 0, 1, 2):
        own = [counts[c, f] for f in range(4)]
        assert max(own) - min(own) <= 1 and sum(own) == sum(1 for _, x in rows if x == c)
    same = {(r["ID"], r["fold"]) for r in with_stratified_folds(df.repartition(3), 4).collect()}
    assert same == {(r["ID"], r["fold"]) for r in folded.collect()}
