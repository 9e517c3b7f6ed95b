"""Density clustering (DBSCAN) of vectors of any length, by a metric cover.

A bounded number of points are pivots. Every point belongs to the cell of its nearest pivot. A neighbour of a point can lie in another
cell only if the point is within eps of that cell's border, which is the plane half-way between the pivots, and within eps
of the ball that holds the cell; so each point visits its own cell and those, and no other. Points of a cell are
ranked by their distance from the pivot and cut into blocks, thin shells by that order; by the triangle inequality a visitor meets
only shells at its own distance plus or minus eps. Blocks are dealt to holds and visitors to streams; a task holds the blocks of a hold
while a stream goes past, and a visitor, sent once to each hold, meets those of its blocks that it has to. So a point travels at most
(holds + streams) times, however many cells it reaches; there are STREAMS of both, more holds only where one would pass HELD_BYTES.

A crowded place costs no pairs of its points: equal points are one point with a weight, and the points within eps / 2 of a
pivot are all neighbours of each other, so if they weigh ``min_points`` they are core points of one cluster and never meet.

Links go from a core point to one member of one connected group that it reaches in a hold; the other groups that it reaches there are
linked with that one unless earlier links of the task do so. That is at most one link a visit and one a group and stream. Clusters are the components of the links, named by their least id. A border point joins the
least-named cluster among its core neighbours.

Rows with a null vector or a null or non-finite component are noise. All vectors must have one length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.density import connected_components
from panelspark.operators.meet import matrix, meet, pack_vectors
from panelspark.operators.order import rank_within
from panelspark.sources.scratch import stored

BLOCK = 2048
STREAMS = 8
HELD_BYTES = 1 << 26  # of the vectors that a task holds, about
MOST_PIVOTS = 4096
PIVOT_BYTES = 1 << 23  # of all pivots together, as they go to every task
SLACK = 1e-9  # of a distance; bounds are kept that much too wide, as they are rounded


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by products, exact to about 1e-12 of the squared lengths."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Which pairs are at most eps apart; those near the limit are decided by their differences."""
    found, limit = squares(a, b), eps * eps
    error = 1e-11 * ((a * a).sum(1).max(initial=0) + (b * b).sum(1).max(initial=0) + limit)
    near = found <= limit
    i, j = np.nonzero(np.abs(found - limit) <= error)
    for at in range(0, len(i), 65_536):
        x, y = i[at:at + 65_536], j[at:at + 65_536]
        near[x, y] = ((a[x] - b[y]) ** 2).sum(1) <= limit
    return near


def groups(near: np.ndarray) -> np.ndarray:
    """Connected groups of a symmetric matrix of links: for each row its group, numbered from 0."""
    group, n = np.full(len(near), -1), 0
    for first in range(len(near)):
        if group[first] >= 0:
            continue
        reached = np.zeros(len(near), bool)
        reached[first] = True
        edge = reached
        while edge.any():
            edge = near[edge].any(0) & ~reached
            reached |= edge
        group[reached] = n
        n += 1
    return group


class _Cover:
    """Pivots, their distances from each other and the radius of each cell."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, self.width = pivots, pivots.shape[1]
        self.apart = np.sqrt(squares(pivots, pivots))
        self.radius = np.zeros(len(pivots))

    def distances(self, points: np.ndarray) -> np.ndarray:
        return np.sqrt(squares(points, self.pivots))

    def reach(self, points: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, distance from its pivot) of all cells that may hold a neighbour of a point."""
        d = self.distances(points)
        home = d.argmin(1)
        own = d[np.arange(len(d)), home][:, None]
        slack = SLACK * (1 + own + eps + self.radius.max(initial=0))
        borders = d * d - own * own <= 2 * (eps + slack) * self.apart[home] + slack
        borders[np.arange(len(d)), home] = True
        i, cell = np.nonzero(borders & (d <= self.radius + eps + slack))
        return i, cell, d[i, cell]


def _homes(cover: _Cover):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = cover.distances(matrix(batch.column("v").to_pylist(), cover.width))
            home = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home, pa.int32()), pa.array(d[np.arange(len(d)), home])], names=[*batch.schema.names, "cell", "far"])

    return run


class _Blocks:
    """The blocks that hold points, by cell, and the hold that each is dealt to."""

    def __init__(self, found: list, cover: _Cover, eps: float, holds: int):
        found = sorted(found, key=lambda r: r["part"])
        self.cell, self.part, self.hold = (np.array([r[c] for r in found], np.int64) for c in ("cell", "part", "hold"))
        self.ball = np.array([r["ball"] for r in found], bool)
        slack = eps + SLACK * (1 + eps + float(cover.radius.max(initial=0)))
        self.low, self.high = np.array([r["low"] for r in found]) - slack, np.array([r["high"] for r in found]) + slack
        cells = np.arange(len(cover.pivots))
        self.first = np.searchsorted(self.cell, cells)
        self.count = np.searchsorted(self.cell, cells, "right") - self.first
        self.holds = holds

    def met(self, row: np.ndarray, cell: np.ndarray, far: np.ndarray, home: np.ndarray, own_ball: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, block) of the visits, by row and hold. Points of a ball don't meet their own ball."""
        n = self.count[cell]
        pair = np.repeat(np.arange(len(cell)), n)
        block = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + self.first[cell][pair]
        row, far = row[pair], far[pair]
        met = (self.low[block] <= far) & (far <= self.high[block])
        met &= ~(own_ball[row] & self.ball[block] & (home[row] == self.cell[block]))
        row, block = row[met], block[met]
        order = np.lexsort((block, self.hold[block], row))
        return row[order], block[order]


def _visits(points: DataFrame, blocks: _Blocks, cover: _Cover, eps: float, streams: int) -> DataFrame:
    """One row of ``points`` (p, v, x, cell, ball) for each hold with blocks that it has to meet; ``parts`` lists these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                rows = batch.slice(at, 1024)
                home, own_ball = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "ball"))
                row, block = blocks.met(*cover.reach(matrix(rows.column("v").to_pylist(), cover.width), eps), home, own_ball)
                visit = row * blocks.holds + blocks.hold[block]
                first = np.flatnonzero(np.diff(visit, prepend=-1))
                parts, ends = blocks.part[block].tobytes(), [*(8 * first).tolist(), 8 * len(block)]
                taken = rows.select(["p", "v", "x"]).take(pa.array(row[first]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks.hold[block[first]], pa.int32()), pa.array(taken.column("p").to_numpy() % streams, pa.int32()), *taken.columns,
                     pa.array(np.zeros(len(first), np.int64)), pa.array([parts[a:b] for a, b in zip(ends, ends[1:])], pa.binary())],
                    names=["hold", "stream", "p", "v", "x", "part", "parts"])

    named = points.select("p", "v", "x", "cell", "ball")
    return named.mapInArrow(run, "hold int, stream int, p long, v binary, x long, part long, parts binary")


def _by_part(block: dict, visitors: dict, width: int) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """(held rows, places of visitors, their vectors) of each held block that some of the visitors meet."""
    if "split" not in block:
        order = np.argsort(block["part"], kind="stable")
        parts, first = np.unique(block["part"][order], return_index=True)
        v = block.pop("v")
        block["split"] = {part: {"p": block["p"][i], "x": block["x"][i], "v": matrix([v[k] for k in i], width)}
                          for part, i in zip(parts.tolist(), np.split(order, first[1:]))}
    size = [len(x) // 8 for x in visitors["parts"]]
    part, row = np.frombuffer(b"".join(visitors["parts"]), np.int64), np.repeat(np.arange(len(size)), size)
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    vectors = matrix(visitors["v"], width)
    for number, i in zip(parts.tolist(), np.split(row[order], first[1:])):
        yield block["split"][number], i, vectors[i]


def _count(width: int, eps: float):
    def answer(block, visitors):
        n = np.zeros(len(visitors["p"]), np.int64)
        for held, i, v in _by_part(block, visitors, width):
            n[i] += within(v, held["v"], eps) @ held["x"]
        yield pa.RecordBatch.from_arrays([pa.array(visitors["p"]), pa.array(n)], names=["p", "n"])

    return answer


class _Joined:
    """Groups of a hold that links of its task have joined so far."""

    def __init__(self):
        self.parent, self.name = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, names: np.ndarray) -> int:
        first = len(self.parent)
        self.parent = np.concatenate([self.parent, np.arange(first, first + len(names))])
        self.name = np.concatenate([self.name, names])
        return first

    def roots(self, group: np.ndarray) -> np.ndarray:
        found = self.parent[group]
        while (above := self.parent[found]).tolist() != found.tolist():
            found = above
        self.parent[group] = found
        return found

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Joins groups pair by pair; places of the pairs that were apart."""
        x, y = self.roots(a), self.roots(b)
        new = []
        for i in np.flatnonzero(x != y).tolist():
            p, q = self.roots(np.array([x[i], y[i]])).tolist()
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                new.append(i)
        return new


def _link(width: int, eps: float):
    """One link a visitor and hold, and one for each two groups of the hold that are found to be joined; ``x`` of the held rows says
    that they are a ball, one group."""
    def answer(block, visitors):
        joined = block.setdefault("joined", _Joined())
        rows, reached = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for held, i, v in _by_part(block, visitors, width):
            if "group" not in held:
                held["group"] = np.zeros(len(held["p"]), int) if held["x"][0] else groups(within(held["v"], held["v"], eps))
                name = np.full(held["group"].max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(name, held["group"], held["p"])
                held["group"] = held["group"] + joined.add(name)
            row, j = np.nonzero(within(v, held["v"], eps))
            pairs = np.unique(np.stack([i[row], held["group"][j]]), axis=1)
            rows.append(pairs[0])
            reached.append(pairs[1])
        row, group = np.concatenate(rows), np.concatenate(reached)
        order = np.argsort(row, kind="stable")
        row, group = row[order], group[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        head = np.repeat(group[first], np.diff(first, append=len(row)))
        pairs = np.unique(np.stack([head, group])[:, head != group], axis=1)
        new = pairs[:, joined.join(*pairs)] if pairs.size else pairs
        a = np.concatenate([visitors["p"][row[first]], joined.name[new[0]]])
        b = np.concatenate([joined.name[group[first]], joined.name[new[1]]])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return answer


def _border(width: int, eps: float):
    def answer(block, visitors):
        most = np.iinfo(np.int64).max
        least = np.full(len(visitors["p"]), most)
        for held, i, v in _by_part(block, visitors, width):
            found = np.where(within(v, held["v"], eps), held["x"][None, :], most).min(1)
            least[i] = np.minimum(least[i], found)
        some = least < most
        yield pa.RecordBatch.from_arrays([pa.array(visitors["p"][some]), pa.array(least[some])], names=["p", "cluster"])

    return answer


def dbscan_vectors(points: DataFrame, eps: float, min_points: int, id_column: str = "id", vector: str = "v", pivots: int | None = None) -> DataFrame:
    """(id, core, cluster) of every row: ``cluster`` is the least id of the cluster's core points, NULL for noise.

    A point is core with ``min_points`` rows within ``eps``, itself included. ``pivots``: by default the square root of the number of
    distinct points, up to MOST_PIVOTS and PIVOT_BYTES.
    """
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    read = points.select(F.col(id_column).cast("long").alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("v"))
    # Adding 0 makes one of the two zeros, which are equal but have different bytes.
    valid = read.filter(finite).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = stored(pack_vectors(valid.withColumn("row", F.monotonically_increasing_id()), "v"), "vectors")
    distinct = rows.groupBy("v").agg(F.min("row").alias("p"), F.count(F.lit(1)).alias("w"), F.min("id").alias("least"))
    distinct = stored(distinct, "distinct-vectors")
    n, short, long = distinct.agg(F.count(F.lit(1)), F.min(F.octet_length("v")), F.max(F.octet_length("v"))).first()
    if short != long:
        raise ValueError("vectors of different lengths")
    noise = read.filter(~F.coalesce(finite, F.lit(False))).select("id", F.lit(False).alias("core"), F.lit(None).cast("long").alias("cluster"))
    if not n:
        return noise
    width = long // 8
    most = max(1, min(MOST_PIVOTS, PIVOT_BYTES // max(long, 1)))
    chosen = distinct.orderBy(F.xxhash64("v"), "v").select("v").limit(min(pivots or math.isqrt(n - 1) + 1, most)).collect()
    cover = _Cover(matrix([r["v"] for r in chosen], width))

    homes = stored(distinct.mapInArrow(_homes(cover), "v binary, p long, w long, least long, cell int, far double"), "cells")
    half = eps / 2 * (1 - SLACK)
    balls = homes.groupBy("cell").agg(F.max("far").alias("radius"), F.sum(F.when(F.col("far") <= half, F.col("w"))).alias("w")).collect()
    for r in balls:  # one row a pivot
        cover.radius[r["cell"]] = r["radius"]
    crowded = [r["cell"] for r in balls if (r["w"] or 0) >= min_points]
    homes = homes.withColumn("ball", (F.col("far") <= half) & F.col("cell").isin(crowded) if crowded else F.lit(False))
    placed = rank_within(homes, ["cell", "ball"], ["far", "p"]).withColumn("block", F.expr(f"rank div {BLOCK}")).drop("rank", "total")
    placed = stored(placed, "blocks-of-cells")
    streams = min(STREAMS, -(-n // BLOCK))
    holds = max(streams, -(-n * long // HELD_BYTES))
    part = F.shiftleft(F.col("cell").cast("long") * 2 + F.col("ball").cast("long"), 32) + F.col("block")
    hold = F.pmod(F.xxhash64(part), F.lit(holds)).cast("int")

    def met(held: DataFrame, visitors: DataFrame, answer, schema: str) -> DataFrame:
        held = held.withColumns({"part": part, "hold": hold})
        # At most two rows a pivot and one for each BLOCK points.
        found = held.groupBy("cell", "ball", "part", "hold").agg(F.min("far").alias("low"), F.max("far").alias("high")).collect()
        visits = _visits(visitors, _Blocks(found, cover, eps, holds), cover, eps, streams)
        every = F.explode(F.sequence(F.lit(0), F.lit(streams - 1))).alias("stream")
        held = held.select("hold", every, "p", "v", "x", "part", F.lit(None).cast("binary").alias("parts"))
        return meet(held, visits, ["hold", "stream"], answer(width, eps), schema)

    weighed = placed.withColumn("x", F.col("w"))
    near = met(weighed, weighed.filter("NOT ball"), _count, "p long, n long").groupBy("p").agg(F.sum("n").alias("near"))
    found = placed.join(near, "p", "left").withColumn("core", F.col("ball") | (F.coalesce("near", F.lit(0)) >= min_points)).drop("near")
    found = stored(found, "core-points")

    core = found.filter("core").withColumn("x", F.col("ball").cast("long"))
    links = met(core, core, _link, "a long, b long")
    heads = core.filter("ball").groupBy("cell").agg(F.min("p").alias("b"))  # at most one row a pivot
    links = links.unionByName(core.filter("ball").join(F.broadcast(heads), "cell").select(F.col("p").alias("a"), "b"))
    label = connected_components(core.select(F.col("p").alias("node")), links)
    named = core.join(label, core["p"] == label["node"])
    least = named.groupBy("label").agg(F.min("least").alias("cluster"))
    clustered = stored(named.join(least, "label").select("cell", "ball", "block", "far", "p", "v", "cluster"), "clustered")

    held = clustered.withColumn("x", F.col("cluster"))
    thin = found.filter("NOT core").withColumn("x", F.lit(0).cast("long"))
    border = met(held, thin, _border, "p long, cluster long").groupBy("p").agg(F.min("cluster").alias("cluster"))
    answer = clustered.select("v", F.lit(True).alias("core"), "cluster").unionByName(
        thin.join(border, "p", "left").select("v", F.lit(False).alias("core"), "cluster"))
    return rows.join(answer, "v").select("id", "core", "cluster").unionByName(noise)
