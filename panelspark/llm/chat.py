"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them in order: text as it is,
every other part as its placeholder, with a reference to what is attached and the number of tokens that the
placeholder expands to. The template puts ``<|im_start|>role``, a line feed, the content, ``<|im_end|>`` and a line
feed around. A run ``<``, backslashes, ``|`` inside a text gets one more backslash, so no text can hold a control string, and
taking one away restores it; in roles backslashes and line feeds are escaped first.

Output is one row a turn, in pieces that stand one after the other in ``turn_index`` order; a conversation is never put
together in one value. Turns are ordered by turn (null first), then role, then text; null role, text and parts count as
empty, rows with a null conv_id form a conversation of their own, repeated rows are turns of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 28  # pixels of a square that one image token stands for
AUDIO_TOKENS = 25  # a second
PAGE_TOKENS = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def text_part(text: Column) -> Column:
    """A PART of kind text."""
    return F.struct(F.lit("text"), text, *[F.lit(None)] * 5).cast(PART)


def _known(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*PLACEHOLDERS), F.lit(False))


def flatten(parts: Column) -> Column:
    """Content of a list of PART, escaped. Texts that touch are joined first, as together they might spell a control string."""
    def visit(done: Column, part: Column) -> Column:
        text = F.coalesce(part["text"], F.lit(""))
        mark = F.lit("")
        for kind, string in PLACEHOLDERS.items():
            mark = F.when(part["type"] == kind, F.lit(string)).otherwise(mark)
        placed = F.struct(F.concat(done["out"], escape(done["open"]), mark).alias("out"), F.lit("").alias("open"))
        return F.when(_known(part), placed).otherwise(
            F.struct(done["out"].alias("out"), F.concat(done["open"], text).alias("open")))

    start = F.struct(F.lit("").alias("out"), F.lit("").alias("open"))
    return F.aggregate(parts, start, visit, lambda done: F.concat(done["out"], escape(done["open"])))


def expanded_tokens(part: Column) -> Column:
    """Tokens that a placeholder expands to: image squares, seconds of sound, pages; at least one."""
    squares = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    count = (
        F.when(part["type"] == "image", squares)
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS))
        .otherwise(F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
    )
    return F.greatest(count.cast("long"), F.lit(1).cast("long"))


def attachments(parts: Column) -> Column:
    """One struct per placeholder, in order: type, uri and expanded tokens."""
    return F.transform(F.filter(parts, _known), lambda p: F.struct(
        p["type"].alias("type"), p["uri"].alias("uri"), expanded_tokens(p).alias("tokens")))


def format_turns(df: DataFrame, parts: str | None = None) -> DataFrame:
    """(conv_id, turn, role, text, head, content, tail, attachments, learned) for each row of (conv_id, turn, role, text).

    ``parts`` names a column of list of PART; without it the text is the only part. ``head``, ``content`` and ``tail``
    one after the other are the formatted turn; ``learned`` says that the loss mask covers the content.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    if parts is None:
        content, found = escape(text), F.array().cast("array<struct<type:string,uri:string,tokens:bigint>>")
    else:
        listed = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
        content, found = flatten(listed), attachments(listed)
    return df.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"), content.alias("content"),
        F.lit(f"{END}\n").alias("tail"), found.alias("attachments"), (role == "assistant").alias("learned"))


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def format_conversations(df: DataFrame, parts: str | None = None) -> DataFrame:
    """(conv_id, turn_index, formatted, loss_start, loss_end, attachments): the formatted turns in order.

    loss_start and loss_end bound the characters of ``formatted`` under the loss mask, null where there are none.
    """
    turns = format_turns(df, parts)
    index = F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order()[1:])) - 1
    start = F.char_length("head")
    return turns.select(
        "conv_id", index.cast("long").alias("turn_index"), F.concat("head", "content", "tail").alias("formatted"),
        F.when(F.col("learned"), start).cast("long").alias("loss_start"),
        F.when(F.col("learned"), start + F.char_length("content")).cast("long").alias("loss_end"), "attachments")


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of every turn of a formatted text, unescaped; placeholders stay."""
    def plain(s: str) -> str:
        return re.sub(r"<\\(\\*)\|", r"<\1|", s)

    def role(s: str) -> str:
        return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", plain(s))

    return [(role(a), plain(b)) for a, b in _TURN.findall(formatted)]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read turns back from rows sorted by (conv_id, turn_index) and digest each conversation as it streams by."""
    from hashlib import sha256

    names = [c.split()[0] for c in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")))

    out = []
    for conv, group in groupby(rows(), lambda r: r[0]):
        n, chars, size, turns, loss = 0, 0, 0, sha256(), sha256()
        for _, text, lo, hi in group:
            for role, content in parse(text):
                n += 1
                turns.update(f"{role}\n{content}\n".encode())
            if lo is not None:
                under = re.sub(r"<\\(\\*)\|", r"<\1|", text[lo:hi])
                chars += len(under)
                loss.update(under.encode())
            size += len(text)
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns say (DIGEST). A conversation streams through one task and is never held."""
    dealt = formatted.select(F.col("conv_id").cast("long"), "turn_index", "formatted", "loss_start", "loss_end")
    return dealt.repartition("conv_id").sortWithinPartitions("conv_id", "turn_index").mapInArrow(digest, DIGEST)
