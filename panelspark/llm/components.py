"""Connected components over a table of links by alternating large-star and small-star contraction.

Every round is two grouped minima; nothing is gathered in one place. A node's minimum reaches its neighbours by a
join on (node, slice), the minimum repeated once a slice, so a hub's links are dealt over SLICES tasks. Rounds end
when the links no longer change; each is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import store

SLICES = 8


def _linked_to_minimum(links: DataFrame, both: bool) -> DataFrame:
    """large-star (both=True): neighbours above u link to the least of u's neighbourhood; small-star: those below."""
    one = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    around = one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else one
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    dealt = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    moved = around.filter("v > u") if both else around
    moved = moved.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SLICES)).cast("int"))
    joined = moved.join(dealt, ["u", "s"]).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not both:
        joined = joined.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return joined.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b long): label is the least node it is connected with.

    Null ends and self-links are ignored, repeated links count once, an empty table gives an empty result.
    """
    links = links.select("a", "b").dropna().filter("a <> b")
    links = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("xxhash64(b, a) % 1000003"))).first())

    before = state(links)
    while before[0]:
        links = store(_linked_to_minimum(_linked_to_minimum(links, True), False), "links")
        after = state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
