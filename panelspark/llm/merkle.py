"""Merkle manifest of a dataset with incremental witnesses.

A row's leaf is a digest; the leaves of a group, in order, are folded two by two, the last one alone if it has no
partner, until one is left, the subroot; the subroots of all groups, in order, are folded alike into the root. A
witness is what turns a leaf into the root again: per level the partner's digest and its side.

Leaves get their exact places by ranges of (group, order). Aligned blocks of BLOCK leaves then stream through the
tasks: an append puts a leaf into the row of open subtrees, one a height, each with the partial witnesses of its
members; where a subtree is completed, both halves' witnesses grow by the other half's digest. The roots of
blocks are appended the same way, BLOCK at a time, until a group has one left, and so are the subroots; going down
again, the witness of a block is put behind those of its members. No task holds more than a block, whatever the size
of a group.

Null groups and null order values come first. Rows equal in all order columns, repeated rows included, are leaves of
their own; equal leaves are put in any order, which changes no result. Texts are hashed whole, a null field as ``-``; a null leaf
counts as zeros. An empty table gives an empty result. Other columns stay, new ones get underscores in front of names taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import free_name, store
from panelspark.operators.order import rank_within

BLOCK = 4096  # a power of two
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"  # sides of a witness's step: no partner, or where the partner stands
SIZE = 32  # bytes of a digest


def frame(column: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*[frame(c) for c in columns]), 256)


def parent(*digests: bytes) -> bytes:
    """Digest of nodes that stand together, each as lower-case hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that ``leaf`` and the steps of its witness give."""
    at = 0
    while at < len(witness):
        side, other = witness[at:at + 1], witness[at + 1:at + 1 + SIZE]
        if side == ALONE:
            leaf, at = parent(leaf), at + 1
        else:
            leaf, at = parent(other, leaf) if side == LEFT else parent(leaf, other), at + 1 + SIZE
    return leaf


def partners(witness: bytes) -> bytes:
    """The partners' digests of a witness, one after the other, as hex text."""
    at, found = 0, []
    while at < len(witness):
        alone = witness[at:at + 1] == ALONE
        if not alone:
            found.append(witness[at + 1:at + 1 + SIZE].hex())
        at += 1 if alone else 1 + SIZE
    return "".join(found).encode()


class Appender:
    """Open subtrees of one block, and the witness of every member up to the subtree that it lies in."""

    def __init__(self):
        self.open: list[tuple[bytes, int] | None] = []  # by height: digest and first member; its members end where the next begin
        self.witnesses: list[bytearray] = []

    def _join(self, left: tuple[bytes, int], right: tuple[bytes, int], end: int) -> tuple[bytes, int]:
        for w in self.witnesses[left[1]:right[1]]:
            w += RIGHT + right[0]
        for w in self.witnesses[right[1]:end]:
            w += LEFT + left[0]
        return parent(left[0], right[0]), left[1]

    def append(self, digest: bytes) -> None:
        node = digest, len(self.witnesses)
        self.witnesses.append(bytearray())
        height = 0
        while height < len(self.open) and self.open[height]:
            node, self.open[height] = self._join(self.open[height], node, len(self.witnesses)), None
            height += 1
        self.open += [None] * (height + 1 - len(self.open))
        self.open[height] = node

    def close(self, height: int) -> bytes:
        """Complete the tree to ``height``, nodes without a partner alone, and return its root."""
        last = None
        for left in (*self.open, *[None] * height)[:height]:
            if left and last:
                last = self._join(left, last, len(self.witnesses))
            elif left or last:
                alone = left or last
                for w in self.witnesses[alone[1]:]:
                    w += ALONE
                last = parent(alone[0]), alone[1]
        return (last or self.open[height])[0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int]]:
    """Rows of one (group, block) after the other, with the number of leaves of the group."""
    held, now = [], None
    for batch in batches:
        keys = list(zip(batch.column("group").to_pylist(), (a // BLOCK for a in batch.column("at").to_pylist())))
        begun = 0
        for i, key in enumerate(keys):
            if now is not None and key != now[0]:
                held.append(batch.slice(begun, i - begun))
                yield pa.Table.from_batches(held), now[1]
                held, begun, now = [], i, None
            if now is None:
                now = key, batch.column("of")[i].as_py()
        held.append(batch.slice(begun))
    if now is not None:
        yield pa.Table.from_batches(held), now[1]


def _append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, of in _blocks(batches):
        tree = Appender()
        for digest in rows["digest"].to_pylist():
            tree.append(digest)
        root = tree.close((min(of, BLOCK) - 1).bit_length())
        kinds = (rows.append_column("witness", pa.array([bytes(w) for w in tree.witnesses], pa.binary()))
                 .append_column("block_root", pa.array([root] + [None] * (len(rows) - 1), pa.binary())))
        yield from kinds.to_batches()


def _level(nodes: DataFrame) -> DataFrame:
    """Nodes (group, at, of, digest, ...) with their ``witness`` inside the block; one a block has its ``block_root``."""
    dealt = nodes.repartition(F.col("group"), F.expr(f"at div {BLOCK}")).sortWithinPartitions("group", "at")
    schema = T.StructType([*nodes.schema.fields, T.StructField("witness", T.BinaryType()), T.StructField("block_root", T.BinaryType())])
    return store(dealt.mapInArrow(_append, schema), "merkle")


def _rise(nodes: DataFrame) -> list[DataFrame]:
    """Levels of blocks from ``nodes`` to one block a group."""
    most = nodes.agg(F.max("of")).first()[0] or 0
    levels = [_level(nodes)]
    while most > BLOCK:
        most = -(-most // BLOCK)
        levels.append(_level(_roots(levels[-1])))
    return levels


def _roots(level: DataFrame) -> DataFrame:
    return level.filter("block_root IS NOT NULL").select(
        "group", F.expr(f"at div {BLOCK}").alias("at"), F.expr(f"(of + {BLOCK - 1}) div {BLOCK}").alias("of"),
        F.col("block_root").alias("digest"))


def _descend(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first level's nodes with whole witnesses; ``above`` has (group, witness, ...) from the top of each group on."""
    extra = [c for c in above.columns if c not in ("group", "witness")]
    above = above.withColumn("at", F.lit(0).cast("long"))
    for i, level in enumerate(reversed(levels)):
        upper = above.select(F.col("group").alias("_group"), F.col("at").alias("_at"), F.col("witness").alias("_above"),
                             *[F.col(c).alias(f"_{c}") for c in extra])
        here = level.drop("block_root")
        same = F.col("group").eqNullSafe(F.col("_group")) & (F.expr(f"at div {BLOCK}") == F.col("_at"))
        joined = here.join(upper, same).withColumn("witness", F.concat("witness", "_above")).drop("_group", "_at", "_above")
        above = joined.withColumnsRenamed({f"_{c}": c for c in extra})
        if i + 1 < len(levels):
            above = above.select("group", "at", "witness", *extra)
    return above


def _hex(leaf: str) -> Column:
    return F.coalesce(F.col(f"`{leaf}`"), F.lit("00" * SIZE))


def manifest(df: DataFrame, leaf: str, by: str, order: list[str]) -> DataFrame:
    """All columns with ``witness`` (binary), ``subroot`` and ``root`` (hex text) of every row.

    ``leaf`` names the digest column (hex text), ``by`` the group; leaves ascend by ``order``, then by leaf.
    """
    names = df.columns
    rows = store(df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.monotonically_increasing_id().alias("salt"),
                           *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)],
                           F.col(f"`{by}`").alias("group"), F.unhex(_hex(leaf)).alias("digest")), "leaves")
    placed = rank_within(rows, ["group"], [*(f"o{i}" for i in range(len(order))), "digest", "salt"], "at", "of")
    levels = _rise(placed.select("group", "at", "of", "digest", "row"))

    tops = _roots(levels[-1]).select(F.col("group").alias("name"), "digest")
    placed = rank_within(tops, [], ["name"], "at", "of")
    over = _rise(placed.select(F.lit(0).alias("group"), "at", "of", "digest", "name"))
    top = _roots(over[-1]).select("group", F.lit(b"").alias("witness"), F.col("digest").alias("root"))
    groups = _descend(over, top).select(F.col("name").alias("group"), "witness", F.col("digest").alias("subroot"), "root")

    found = _descend(levels, groups)
    new = [free_name(df, c) for c in ("witness", "subroot", "root")]
    return found.select("row.*", F.col("witness").alias(new[0]), F.lower(F.hex("subroot")).alias(new[1]), F.lower(F.hex("root")).alias(new[2]))


def verify(df: DataFrame, leaf: str, witness: str = "witness") -> DataFrame:
    """All columns with ``folded_root``, what ``leaf`` (hex text) and the witness give, and ``proof_sha256`` over the partners."""
    own = free_name(df, "leaf_of")
    names = [free_name(df, c) for c in ("folded_root", "proof_sha256")]
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.StringType()) for c in names)])
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            witnesses = batch.column(witness).to_pylist()
            folded = [fold(bytes.fromhex(d), w).hex() for d, w in zip(batch.column(own).to_pylist(), witnesses)]
            proofs = [sha256(partners(w)).hexdigest() for w in witnesses]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(folded, pa.string()), pa.array(proofs, pa.string())], names=schema.fieldNames())

    return df.withColumn(own, _hex(leaf)).mapInArrow(run, schema)
