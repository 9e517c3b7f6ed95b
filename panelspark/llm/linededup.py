"""Line deduplication by pairwise alignment.

Lines (blanks around them cut) are compared by hash. Anchors are what recurs among: lines of LONG characters or more; windows,
which are the fewest consecutive shorter lines from some line on that have LONG characters together; and single shorter lines
that occur FEW times at most. The first two tell a common block alone, at any frequency, and every common block of LONG
characters holds one. Each document that holds one is aligned with the first document that does, so a line in a third of all
documents makes one pair for each of them and no more; short rare lines pair all documents that hold them. For each pair the
shared anchors (one that recurs in a document counts by its ordinal there) are put in the order of the first document, and
patience sorting finds the longest run of them that is in order in both. Aligned anchors grow over equal lines before and
behind, rare or not, up to the next anchor. Blocks whose anchors have LONG characters together are deleted from the later
document; the first one stays whole.

The same is then done with what is left of the documents, short rare lines aside, until nothing more is found. An anchor that
an alignment left in the later document, as it stands in another order there, meets the first of the other documents it
was left in, and so on: in the end all documents that still share an anchor have been aligned with each other on it.

Documents follow each other by doc_id (null first), then by the hash of their text; rows equal in both are one document and
get the same result. Null text counts as empty. Deleting every line leaves an empty text. An empty table gives an empty result,
and all columns of the input stay.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import BLANKS, free_name, store, text_of

LONG = 30
FEW = 16
DOC = pa.struct([("doc_id", pa.int64()), ("key", pa.int64())])
UNITS = "d struct<doc_id:long,key:long>, i int, pos int, h long, h2 int, n int, size int"
OCCURRENCES = ("h long, h2 int, k int, g int, first boolean, strong boolean, d struct<doc_id:long,key:long>, i int, pos int, "
               "n int, size int, before array<bigint>, behind array<bigint>")
DELETED = "d struct<doc_id:long,key:long>, removed array<boolean>, aligned_with array<bigint>"


def aligned(pairs: list[tuple[int, int]]) -> list[int]:
    """Indices of a longest run of (position, position), sorted by the first, that ascends in the second: patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    previous = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        if pile == len(tops):
            tops.append(b)
            at.append(i)
        else:
            tops[pile], at[pile] = b, i
        previous[i] = at[pile - 1] if pile else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = previous[i]
    return out[::-1]


def removed_lines(rows: list[dict], least: int = LONG) -> tuple[set[int], set]:
    """Lines to delete from one document, and the earlier documents that have them; ``rows``: its anchors with their partners'."""
    gone, partners = set(), set()
    by_partner: dict = {}
    for r in rows:
        by_partner.setdefault((r["a_id"], r["a_key"]), []).append(r)
    for (a_id, _), shared in by_partner.items():
        # Of a line and the window that starts with it only the window counts.
        shared.sort(key=lambda r: (r["a_pos"], r["b_pos"], -r["size"]))
        shared = [r for q, r in zip([None, *shared], shared) if not q or (q["a_pos"], q["b_pos"]) != (r["a_pos"], r["b_pos"])]
        block: dict[int, int] = {}
        for i in aligned([(r["a_pos"], r["b_pos"]) for r in shared]):
            r = shared[i]
            at = r["b_pos"]
            for p in range(at, at + r["size"]):
                block[p] = max(r["n"], block.get(p, 0))
            for step, (x, y) in enumerate(zip(r["a_behind"], r["b_behind"]), r["size"]):
                if x != y:
                    break
                block.setdefault(at + step, 0)
            for step, (x, y) in enumerate(zip(reversed(r["a_before"]), reversed(r["b_before"])), 1):
                if x != y:
                    break
                block.setdefault(at - step, 0)
        run: list[int] = []
        for at in [*sorted(block), None]:
            if run and at != run[-1] + 1:
                if sum(block[p] for p in run) >= least:
                    gone.update(run)
                    partners.add(a_id)
                run = []
            run.append(at)
    return gone, partners


def windows(n: list[int]) -> Iterator[tuple[int, int]]:
    """(first, last) of the fewest consecutive lines, two or more, that have LONG characters together, for each line from which
    on there are such before a line of LONG characters; ``n``: characters of each line. They start and end with no blank line."""
    last, total = -1, 0
    for i, own in enumerate(n):
        if not 0 < own < LONG:
            continue
        if last < i:
            last, total = i, own
        while total < LONG and last + 1 < len(n) and n[last + 1] < LONG:
            last += 1
            total += n[last]
        if total >= LONG:
            yield i, last
        total -= own


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["d", "i", "pos", "h", "h2", "n", "size"]
    types = [DOC, pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    for batch in batches:
        out = []
        ids = batch.column("d")
        for row, (pos, h, n) in enumerate(zip(*(batch.column(c) for c in ("pos", "h", "n")))):
            sizes = n.values.to_numpy()
            short = (sizes > 0) & (sizes < LONG)
            if np.count_nonzero(short) < 2:
                continue
            hashes, d, places = h.values.to_numpy().tobytes(), ids[row].as_py(), pos.values
            ends = np.cumsum(sizes).tolist()
            sizes = sizes.tolist()
            for i, j in windows(sizes):
                x = blake2b(hashes[8 * i:8 * j + 8], digest_size=12).digest()
                out.append((d, i, places[i].as_py(), int.from_bytes(x[:8], "little", signed=True),
                            int.from_bytes(x[8:], "little", signed=True), ends[j] - ends[i] + sizes[i], j - i + 1))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each anchor of each document its place and the lines around it that it may grow over: up to the anchors around it,
    for a window up to the end of the next one, as equal lines farther off have anchors of their own."""
    names = ["h", "h2", "k", "g", "first", "strong", "d", "i", "pos", "n", "size", "before", "behind"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), DOC, pa.int32(), pa.int32(), pa.int32(),
             pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    for batch in batches:
        out = []
        for doc in batch.to_pylist():
            h, n = doc["h"], doc["n"]
            marks = sorted(doc["marks"], key=lambda x: (x["i"], x["size"]))
            single = [x["i"] for x in marks if x["size"] == 1]
            ends = dict(windows(n)) if len(single) < len(marks) else {}
            seen: Counter = Counter()
            for x in marks:
                i, size = x["i"], x["size"]
                at = bisect_left(single, i)
                lo = single[at - 1] + 1 if at else 0
                at = bisect_left(single, i + size)
                hi = single[at] if at < len(single) else len(h)
                if size > 1:
                    near = i
                    while near > lo and n[near - 1] == 0:
                        near -= 1
                    lo, following = near, i + 1
                    while n[following] == 0:
                        following += 1
                    far = ends.get(following)
                    if far is None:
                        far = i + size
                        while far < hi and n[far] < LONG:
                            far += 1
                    hi = max(i + size, min(hi, far))
                k = seen[x["h"], x["h2"], x["g"]]
                seen[x["h"], x["h2"], x["g"]] += 1
                out.append((x["h"], x["h2"], k, x["g"], x["f"] == doc["d"], x["strong"], doc["d"], i, x["pos"], x["n"], size,
                            h[lo:i], h[i + size:hi]))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc in batch.to_pylist():
            gone, partners = removed_lines(doc["shared"])
            if gone:
                flags = [p in gone for p in range(max(gone) + 1)]
                out.append((doc["d"], flags, sorted(partners, key=lambda p: (p is not None, p or 0))))
        if out:
            ids, flags, partners = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, DOC), pa.array(flags, pa.list_(pa.bool_())), pa.array(partners, pa.list_(pa.int64()))],
                names=["d", "removed", "aligned_with"])


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc in batch.to_pylist():
            flags = np.zeros(max(doc["gone"]) + 1, bool)
            flags[doc["gone"]] = True
            out.append((doc["d"]["doc_id"], doc["d"]["key"], flags, sorted(set(doc["w"]), key=lambda p: (p is not None, p or 0))))
        if out:
            types = [pa.int64(), pa.int64(), pa.list_(pa.bool_()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             names=["doc_id", "key", "removed", "aligned_with"])


def _anchors(left: DataFrame, tried: DataFrame | None) -> DataFrame:
    """(d, marks) of the documents with anchors. ``tried``: how many documents each place was aligned with in vain; without it
    short rare lines are anchors too."""
    lines = left.select("d", F.posexplode(F.arrays_zip("pos", "h", "h2", "n")).alias("i", "x")).select(
        "d", "i", "x.pos", "x.h", "x.h2", "x.n", F.lit(1).alias("size")).filter("n > 0" if tried is None else f"n >= {LONG}")
    units = lines.unionByName(store(left.mapInArrow(_windows, UNITS), "windows")).withColumn("g", F.lit(0))
    if tried is not None:
        units = store(units.drop("g").join(tried, ["d", "pos", "h", "h2"], "left").withColumn("g", F.coalesce("g", F.lit(0))), "units")
    strong = (F.col("n") >= LONG) | (F.col("size") > 1)
    counts = units.groupBy("h", "h2", "g").agg(F.count("*").alias("c"), F.max("n").alias("n"), F.max("size").alias("size"), F.min("d").alias("f"))
    found = store(counts.filter((F.col("c") > 1) & (strong | (F.col("c") <= FEW))).select("h", "h2", "g", "f", strong.alias("strong")), "anchors")
    return units.join(found, ["h", "h2", "g"]).groupBy("d").agg(
        F.collect_set(F.struct("i", "pos", "h", "h2", "n", "size", "g", "f", "strong")).alias("marks"))


def _pairs(places: DataFrame) -> DataFrame:
    """Shared anchors, one row for each of a document and an earlier one."""
    later = places.select("h", "h2", "k", "g", "first", "strong", "d", F.col("i").alias("b_pos"), "n", "size",
                          F.col("before").alias("b_before"), F.col("behind").alias("b_behind"))
    earlier = places.select("h", "h2", "k", "g", "first", "strong", F.col("d").alias("a"), F.col("i").alias("a_pos"),
                            F.col("before").alias("a_before"), F.col("behind").alias("a_behind"))
    shared, same = ["a", "d", "a_pos", "b_pos", "n", "size", "a_before", "b_before", "a_behind", "b_behind"], ["h", "h2", "k", "g"]
    of_first = later.filter("strong AND NOT first").join(store(earlier.filter("strong AND first").drop("first", "strong"), "first-places"), same)
    of_all = later.filter("NOT strong").join(earlier.filter("NOT strong").drop("first", "strong"), same).filter("a < d")
    return of_first.select(shared).unionByName(of_all.select(shared))


def deletions(df: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, key, removed, aligned_with) of the documents that lose lines: a flag for each line, by place, up to the last
    one removed. ``key`` is xxhash64 of the text."""
    body = text_of(text)
    docs = df.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("key")).alias("d"), body.alias("t"))
    lines = F.transform(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    left = store(docs.select("d", lines.alias("l")).select(
        "d", F.sequence(F.lit(0), F.size("l") - 1).alias("pos"), F.transform("l", lambda x: F.xxhash64(x)).alias("h"),
        F.transform("l", lambda x: F.hash(x)).alias("h2"), F.transform("l", lambda x: F.char_length(x)).alias("n")), "lines")
    tried, found = None, []
    while True:
        marked = left.dropDuplicates(["d"]).join(_anchors(left, tried), "d")
        marked = store(marked, "marked-lines")
        places = store(marked.mapInArrow(_occurrences, OCCURRENCES), "anchor-places")
        shared = _pairs(places).groupBy("d").agg(F.collect_list(F.struct(
            F.col("a.doc_id").alias("a_id"), F.col("a.key").alias("a_key"), "a_pos", "b_pos", "n", "size", "a_before", "b_before",
            "a_behind", "b_behind")).alias("shared"))
        gone = store(shared.mapInArrow(_align, DELETED), "deletions")
        again = tried is not None
        if again and gone.isEmpty():
            break
        cut = marked.drop("marks").join(gone, "d", "left")
        is_gone = lambda i: F.coalesce(F.get(F.col("removed"), i), F.lit(False))
        found.append(cut.filter("removed IS NOT NULL").select("d", F.filter("pos", lambda _, i: is_gone(i)).alias("gone"), "aligned_with"))
        left = store(cut.select("d", *(F.filter(c, lambda _, i: ~is_gone(i)).alias(c) for c in ("pos", "h", "h2", "n"))).filter(F.size("pos") > 0), "lines")
        vain = places.filter("strong AND NOT first").select("d", "pos", "h", "h2", (F.col("g") + 1).alias("g"))
        tried = vain if tried is None else tried.unionByName(vain)
        tried = store(tried.groupBy("d", "pos", "h", "h2").agg(F.max("g").alias("g")), "tried")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    sums = every.groupBy("d").agg(F.flatten(F.collect_list("gone")).alias("gone"), F.flatten(F.collect_list("aligned_with")).alias("w"))
    return store(sums.mapInArrow(_flags, "doc_id long, key long, removed array<boolean>, aligned_with array<bigint>"), "deletions")


def dedup_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its texts cut, and with n_lines, n_removed and aligned_with (ids of the earlier documents that have the
    removed lines)."""
    key, lines = free_name(df, "_of_text"), F.split(text_of(text), "\n")
    removed, partners = free_name(df, "_removed"), free_name(df, "aligned_with")
    own_id, own_key = free_name(df, "_id"), free_name(df, "_key")
    gone = deletions(df, text).withColumnsRenamed({"doc_id": own_id, "key": own_key, "removed": removed, "aligned_with": partners})
    with_key = df.withColumn(key, F.xxhash64(text_of(text)))
    found = with_key.join(gone, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.get(F.col(removed), i), F.lit(False))), "\n")
    count = F.coalesce(F.size(F.filter(removed, lambda x: x)), F.lit(0))
    return found.select(
        *(F.when(F.col(removed).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text else F.col(c) for c in df.columns),
        F.size(lines).cast("long").alias(free_name(df, "n_lines")), count.cast("long").alias(free_name(df, "n_removed")),
        F.coalesce(partners, F.array().cast("array<bigint>")).alias(partners))
