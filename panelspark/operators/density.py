"""Density clustering (DBSCAN) of points in the plane.

The plane is cut into square cells of side eps / sqrt(2), so any two points of a cell are
neighbours. That makes crowded places cheap:

* a cell with ``min_points`` points has only core points, nobody counts their neighbours;
* only points of thin cells (fewer than ``min_points`` points) look at the 20 cells around
  them, and a cell is looked at by at most 20 * (min_points - 1) of those;
* all core points of a cell belong together, so clusters are components of a graph of cells.

Two crowded cells are linked through the bounding boxes of ever smaller sub-cells: boxes that
are surely within reach link the cells, boxes surely out of reach are dropped, and only the
undecided ones are halved again. Pairs of points are never listed.
"""

from __future__ import annotations

import math
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.scratch import cut_lineage

POINTS_PER_SALT = 500_000
DEEPEST = 50  # halvings of a cell; doubles tell no more apart
# Cells within reach of a cell: two steps in each direction, without the four corners.
_STEPS = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if abs(a) + abs(b) < 4]


def dbscan(points: DataFrame, eps: float = 0.5, min_points: int = 5, salts: int | None = None) -> DataFrame:
    """(id, x, y) -> (id, core, cluster). ``cluster`` is the smallest cell label of the component,
    NULL for noise. A border point joins the smallest cluster among its core neighbours.

    ``salts`` spreads a crowded cell over that many join keys; by default as many as the most
    crowded cell needs.
    """
    side = eps / math.sqrt(2.0)
    placed = points.selectExpr("id", "x", "y", f"floor(x / {side!r}D) AS cx", f"floor(y / {side!r}D) AS cy")
    sizes = placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    if salts is None:
        largest = sizes.agg(F.max("n")).first()[0] or 0
        salts = max(1, math.ceil(largest / POINTS_PER_SALT))
    core = cut_lineage(core_points(placed.join(sizes, ["cx", "cy"]), eps, min_points, salts))
    labels = _cell_components(core.where("core"), eps, side)
    own = core.join(labels, ["cx", "cy"], "left")
    thin = own.where("NOT core").select("id", "x", "y", "cx", "cy")
    crowd = _salted(own.where("core").select("cx", "cy", "x", "y", "label"), salts).alias("p")
    border = (
        _around(thin, salts).alias("q").join(crowd, ["cx", "cy", "salt"])
        .where(_within(eps)).groupBy("q.id").agg(F.min("p.label").alias("near"))
    )
    return own.join(border, "id", "left").selectExpr("id", "core", "if(core, label, near) AS cluster")


def core_points(placed: DataFrame, eps: float, min_points: int, salts: int) -> DataFrame:
    """Adds ``core``: at least ``min_points`` points within eps, the point itself included."""
    thin = placed.where(F.col("n") < min_points).select("id", "x", "y", "cx", "cy")
    everyone = _salted(placed.select("cx", "cy", "x", "y"), salts).alias("p")
    counts = (
        _around(thin, salts).alias("q").join(everyone, ["cx", "cy", "salt"])
        .where(_within(eps)).groupBy("q.id").agg(F.count(F.lit(1)).alias("near"))
    )
    return placed.join(counts, "id", "left").selectExpr(
        "id", "x", "y", "cx", "cy", f"n >= {min_points} OR coalesce(near, 0) >= {min_points} AS core"
    )


def _around(df: DataFrame, salts: int) -> DataFrame:
    """One copy of a point per cell within reach and salt, under that cell's coordinates."""
    steps = ", ".join(f"named_struct('a', {a}, 'b', {b})" for a, b in _STEPS)
    near = df.selectExpr("*", f"explode(array({steps})) AS s")
    moved = near.selectExpr("id", "x", "y", "cx + s.a AS cx", "cy + s.b AS cy")
    return moved.selectExpr("*", f"explode(sequence(0, {salts - 1})) AS salt")


def _salted(df: DataFrame, salts: int) -> DataFrame:
    """Spread the points of a crowded cell over several join keys."""
    return df.selectExpr("*", f"int(pmod(xxhash64(x, y), {salts})) AS salt")


def _within(eps: float) -> str:
    return f"(q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y) <= {eps * eps!r}D"


# --- linking cells ----------------------------------------------------------------------------

_CELLS = ["ax", "ay", "bx", "by"]
_SUB = ["asx", "asy", "bsx", "bsy"]


def _boxes(core: DataFrame, side: float, level: int) -> DataFrame:
    """Bounding boxes of the core points per sub-cell (2**level per side), and the parent sub-cell."""
    small = side / 2**level
    boxes = core.selectExpr(
        "cx", "cy", "x", "y", f"floor(x / {small!r}D) AS sx", f"floor(y / {small!r}D) AS sy"
    ).groupBy("cx", "cy", "sx", "sy").agg(
        F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi")
    )
    return boxes.selectExpr("*", "shiftright(sx, 1) AS px", "shiftright(sy, 1) AS py")


def _decide(pairs: DataFrame, eps: float) -> DataFrame:
    """Drop box pairs out of reach; ``sure`` marks those where every point pair is in reach."""
    def square(axis: str, kind: str) -> str:
        a_lo, a_hi, b_lo, b_hi = (f"{t}.{axis}_{e}" for t in "ab" for e in ("lo", "hi"))
        length = (
            f"greatest(0D, {a_lo} - {b_hi}, {b_lo} - {a_hi})" if kind == "near"
            else f"greatest({a_hi} - {b_lo}, {b_hi} - {a_lo})"
        )
        return f"pow({length}, 2)"

    limit = f"<= {eps * eps!r}D"
    return pairs.where(f"{square('x', 'near')} + {square('y', 'near')} {limit}").selectExpr(
        "o.ax", "o.ay", "o.bx", "o.by", "a.sx AS asx", "a.sy AS asy", "b.sx AS bsx", "b.sy AS bsy",
        f"{square('x', 'far')} + {square('y', 'far')} {limit} AS sure",
    )


def _cell_links(core: DataFrame, eps: float, side: float) -> DataFrame:
    """Pairs of cells (ax, ay, bx, by) with core points in reach of each other, a before b."""
    forward = ", ".join(f"named_struct('a', {a}, 'b', {b})" for a, b in _STEPS if (a, b) > (0, 0))
    cells = core.select("cx", "cy").distinct()
    reach = cells.selectExpr("cx AS ax", "cy AS ay", f"explode(array({forward})) AS m").selectExpr(
        "ax", "ay", "ax + m.a AS bx", "ay + m.b AS by"
    )
    pairs = reach.join(cells.selectExpr("cx AS bx", "cy AS by"), ["bx", "by"], "left_semi").selectExpr(
        *_CELLS, "ax AS asx", "ay AS asy", "bx AS bsx", "by AS bsy"
    )
    links = None
    for level in count():
        if level > DEEPEST:
            raise RuntimeError(f"cells are still undecided at boxes of {side / 2**level}: eps is below the points' precision")
        boxes = _boxes(core, side, level)
        # At level 0 the boxes are the cells themselves, below they are halves of the pairs' boxes.
        x, y = ("sx", "sy") if level == 0 else ("px", "py")
        joined = pairs.alias("o")
        for t in "ab":
            same = f"o.{t}x = {t}.cx AND o.{t}y = {t}.cy AND o.{t}sx = {t}.{x} AND o.{t}sy = {t}.{y}"
            joined = joined.join(boxes.alias(t), F.expr(same))
        decided = cut_lineage(_decide(joined, eps))
        found = decided.where("sure").select(*_CELLS).distinct()
        pairs = decided.where("NOT sure").join(found, _CELLS, "left_anti").select(*_CELLS, *_SUB)
        links = found if links is None else links.unionByName(found)
        if pairs.isEmpty():
            break
    return links


def _cell_components(core: DataFrame, eps: float, side: float) -> DataFrame:
    """(cx, cy, label): smallest cell name of each connected set of cells."""
    nodes = core.selectExpr("cx", "cy", "format_string('%d:%d', cx, cy) AS node").distinct()
    links = _cell_links(core, eps, side).selectExpr(
        "format_string('%d:%d', ax, ay) AS a", "format_string('%d:%d', bx, by) AS b"
    )
    labels = connected_components(nodes.select("node"), links)
    return nodes.join(labels, "node").select("cx", "cy", "label")


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) with the smallest node name of each component.

    Alternating star contraction: every node points to the smallest node it knows, and big
    neighbours are re-linked to it, so long chains shrink by a constant factor per round and no
    round sends more rows than there are links.
    """
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # Large star: neighbours above a node move to the smallest node it knows.
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: neighbours below a node, and the node itself, move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = cut_lineage(small)
        changed = small.exceptAll(edges).unionByName(edges.exceptAll(small))
        edges = small
        if changed.isEmpty():
            break
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("root", "node").alias("label")
    )
