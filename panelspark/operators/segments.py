"""Ordered text segments: typed segments to one marked text, and marked text back to segments.

A document is written in parts of at most ``part_segments`` consecutive segments, so a very long
document is spread over many rows; its text is its parts in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The marker lines of the text format.
MARKERS = {"code": "# --- Code Cell", "markdown": "# --- Markdown Cell"}
MARKER_TAIL = " ---\n"


def commented(text: Column) -> Column:
    """Put ``# `` before every line that does not start with ``#``."""
    return F.when(text == "", text).otherwise(F.regexp_replace(text, r"(?md)^(?!#)", "# "))


def read_notebooks(spark, path: str) -> DataFrame:
    """Notebook JSON files as segments (doc, pos, kind, text)."""
    schema = "cells array<struct<cell_type:string, source:array<string>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    cells = raw.select(F.input_file_name().alias("doc"), F.posexplode("cells").alias("pos", "cell"))
    return cells.select("doc", "pos", F.col("cell.cell_type").alias("kind"), F.array_join("cell.source", "").alias("text"))


def join_segments(
    segments: DataFrame,
    include_code: bool = True,
    include_markdown: bool = True,
    part_segments: int = 1000,
) -> DataFrame:
    """(doc, part, text) from segments (doc, pos, kind, text); other kinds are left out."""
    wanted = [k for k, use in (("code", include_code), ("markdown", include_markdown)) if use]
    kind, text = F.col("kind"), F.coalesce("text", F.lit(""))
    header = F.when(kind == "code", MARKERS["code"]).otherwise(MARKERS["markdown"])
    body = F.when(kind == "code", text).otherwise(commented(text))
    lines = segments.where(kind.isin(wanted)).select(
        "doc",
        F.floor(F.col("pos") / part_segments).alias("part"),
        "pos",
        F.concat(header, F.lit(MARKER_TAIL), body, F.lit("\n")).alias("piece"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return lines.groupBy("doc", "part").agg(pieces.alias("p")).select(
        "doc", "part", F.array_join(F.col("p.piece"), "").alias("text")
    )


def split_segments(texts: DataFrame) -> DataFrame:
    """(doc, cell, part, kind, text) from marked text (doc, part, text).

    A marker line closes the running segment and gives the next one its kind; text before the
    first marker is code; blank lines at both ends are cut; empty segments are dropped. A segment
    that runs over several parts comes as one row per part, in part order, so that no row is
    longer than the text it came from.
    """
    # A part ends with a line break; what follows it is no line unless it has content.
    n = F.size(F.split(F.col("text"), "\n", -1))
    lines = texts.select("doc", "part", n.alias("n"), F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    lines = lines.where((F.col("line") < F.col("n") - 1) | (F.col("content") != ""))
    stripped = F.trim(F.col("content"))
    marker = F.when(stripped.startswith(MARKERS["code"]), "code").when(
        stripped.startswith(MARKERS["markdown"]), "markdown"
    )
    marked = lines.withColumn("marker", marker)
    inside = W.partitionBy("doc", "part").orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    local = marked.withColumns(
        {
            "here": F.count("marker").over(inside),
            "kind_here": F.last("marker", ignorenulls=True).over(inside),
        }
    )
    # Parts pass on how many markers came before them and which was the last.
    order = W.partitionBy("doc").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = marked.groupBy("doc", "part").agg(
        F.count("marker").alias("markers"),
        F.max_by("marker", F.when(F.col("marker").isNotNull(), F.col("line"))).alias("final"),
    )
    parts = parts.select(
        "doc",
        "part",
        F.coalesce(F.sum("markers").over(order), F.lit(0)).alias("before"),
        F.last("final", ignorenulls=True).over(order).alias("kind_before"),
    )
    placed = local.where(F.col("marker").isNull()).join(parts, ["doc", "part"])
    placed = placed.select(
        "doc",
        (F.col("here") + F.col("before")).alias("cell"),
        F.coalesce("kind_here", "kind_before", F.lit("code")).alias("kind"),
        "part",
        "line",
        "content",
    )
    at = F.struct("part", "line")
    # First and last line with content; a segment without any is dropped by the join.
    ends = placed.where(F.col("content") != "").groupBy("doc", "cell").agg(
        F.min(at).alias("first"), F.max(at).alias("last")
    )
    body = placed.join(ends, ["doc", "cell"]).where((at >= F.col("first")) & (at <= F.col("last")))
    pieces = body.groupBy("doc", "cell", "part", "kind").agg(
        F.array_sort(F.collect_list(F.struct("line", "content"))).alias("lines")
    )
    return pieces.select("doc", "cell", "part", "kind", F.array_join(F.col("lines.content"), "\n").alias("text"))
