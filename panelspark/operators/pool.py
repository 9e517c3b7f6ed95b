"""Spark work side by side: several jobs over one stored or persisted frame at a time.

Each piece of work runs in a thread of its own with the caller's local properties. All jobs of one call share a job tag, so if a piece
fails, the others' jobs are cancelled, pieces that wait are dropped and the first error is raised. At most ``width`` pieces run at a
time; each gets a scheduler pool of its own, which with fair scheduling shares the executors among them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
WIDTH = 8


def side_by_side(spark: SparkSession, work: Sequence[Callable[[], T]], width: int | None = None) -> list[T]:
    """The results of all pieces of ``work``, in their order. ``width``: by default the cores Spark offers, up to WIDTH."""
    context = spark.sparkContext
    width = width or max(1, min(WIDTH, context.defaultParallelism))
    if width == 1 or len(work) < 2:
        return [piece() for piece in work]
    tag = f"side-by-side-{uuid.uuid4().hex}"

    def run(place: int, piece: Callable[[], T]) -> T:
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", f"piece-{place % width}")
        try:
            return piece()
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(width) as pool:
        # The target is made here, in the caller's thread, whose properties it takes along.
        futures = [pool.submit(inheritable_thread_target(spark)(lambda i=i, p=p: run(i, p))) for i, p in enumerate(work)]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        if failed := [f for f in futures if f in done and not f.cancelled() and f.exception()]:
            for f in waiting:
                f.cancel()
            context.cancelJobsWithTag(tag)
            raise failed[0].exception()
    return [f.result() for f in futures]
