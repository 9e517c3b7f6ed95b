"""Token ids in length-delimited binary records with a separate offset index.

Record: payload length (unsigned 64 bit), its masked checksum, payload, the payload's masked checksum (32 bit each,
little-endian). Payload: one byte of flags (1: doc_id is null, 2: ids have 16 bits), doc_id (signed 64 bit), the ids
(unsigned, 16 bit if all fit, else 32).
Checksum: CRC-32 as in zlib, rotated right by 15 bits plus a constant, so that a checksum of data that holds
checksums stays sound. Index: for each record of the data file its offset and the number of ids before it, unsigned
64 bit each; record n is found without reading others, so reads may come in any order.

Documents are dealt by ranges of doc_id, so files follow each other in ascending order: null first, then by value,
equal ones by the hash of their text. A task writes to names of its own attempt and the manifest lists only files of
tasks that ended, so repeated attempts do no harm. Null text counts as empty. An empty table writes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.common import store, text_of
from panelspark.llm.wordtokens import encode_texts, id_lists
from panelspark.sources.scratch import scratch_path

CHUNK = 1024  # records that one read range holds
_MASK = 0xA282EAD8  # fixed value of the mask
_HEAD, _SUM, _INDEX, _KEY = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<QQ"), struct.Struct("<Bq")
MANIFEST = "part int, data string, index string, records long, ids long"
DOCUMENTS = "doc_id long, part int, record long, start long, ids array<int>"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + _SUM.pack(masked(length)) + payload + _SUM.pack(masked(payload))


def payload_of(doc: int | None, ids: bytes) -> bytes:
    wide = np.frombuffer(ids, "<u4")
    short = not len(wide) or int(wide.max()) < 1 << 16
    return _KEY.pack((doc is None) | 2 * short, doc or 0) + (wide.astype("<u2").tobytes() if short else ids)


def parse_payload(payload: bytes) -> tuple[int | None, bytes]:
    """doc_id and the ids as 32-bit integers."""
    flags, doc = _KEY.unpack_from(payload)
    ids = payload[_KEY.size:]
    return (None if flags & 1 else doc), (np.frombuffer(ids, "<u2").astype("<u4").tobytes() if flags & 2 else ids)


def read_frame(source) -> bytes:
    head = source.read(_HEAD.size)
    length, check = _HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("damaged record length")
    payload = source.read(length)
    if len(payload) < length or masked(payload) != _SUM.unpack(source.read(4))[0]:
        raise ValueError("damaged record")
    return payload


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    files, base = FileSystem.from_uri(folder)
    name = f"{base}/part-{part:06d}-{uuid.uuid4().hex}"
    last = np.array([end], np.uint32).tobytes()
    data = index = None
    offset = records = total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if data is None:
            files.create_dir(base, recursive=True)
            data, index = files.open_output_stream(f"{name}.rec"), files.open_output_stream(f"{name}.idx")
        docs = batch.column("doc_id").to_pylist()
        for doc, ids in zip(docs, encode_texts(batch.column("t").cast(pa.binary()).to_pylist(), tokenizer)):
            record = frame(payload_of(doc, ids + last))
            data.write(record)
            index.write(_INDEX.pack(offset, total))
            offset, records, total = offset + len(record), records + 1, total + len(ids) // 4 + 1
    if data is not None:
        data.close()
        index.close()
        uri = f"{folder}/{name.rsplit('/', 1)[-1]}"
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "data": [f"{uri}.rec"], "index": [f"{uri}.idx"],
                                          "records": [records], "ids": [total]})


def write(df: DataFrame, tokenizer: str, end: int = 1, text: str = "text", folder: str | None = None) -> DataFrame:
    """Write the records to ``folder`` (default: a fresh one in the shared folder); returns the manifest, itself stored."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "records")
    if "://" not in folder and not folder.startswith("/"):
        folder = folder.removeprefix("file:")
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("t")]
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("t"))
    dealt = texts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    return store(dealt.mapInArrow(lambda batches: _write(batches, folder, tokenizer, end), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch], seed: int | None) -> Iterator[pa.RecordBatch]:
    for row in (r for batch in batches for r in batch.to_pylist()):
        files, path = FileSystem.from_uri(row["index"])
        lo, n = row["lo"], min(CHUNK, row["records"] - row["lo"])
        with files.open_input_file(path) as source:
            source.seek(_INDEX.size * lo)
            at = np.frombuffer(source.read(_INDEX.size * n), "<u8").reshape(-1, 2)
        order = np.arange(n) if seed is None else np.random.default_rng([seed, row["part"], lo]).permutation(n)
        files, path = FileSystem.from_uri(row["data"])
        out, size = [], 0

        def batch_of(rows: list[tuple], part: int = row["part"]) -> pa.RecordBatch:
            doc, record, start, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array(record, pa.int64()),
                 pa.array(start, pa.int64()), id_lists(list(ids))], names=["doc_id", "part", "record", "start", "ids"])

        with files.open_input_file(path) as source:
            for k in order.tolist():
                source.seek(int(at[k, 0]))
                doc, ids = parse_payload(read_frame(source))
                out.append((doc, lo + k, row["before"] + int(at[k, 1]), ids))
                size += len(ids)
                if size > 1 << 22:
                    yield batch_of(out)
                    out, size = [], 0
        if out:
            yield batch_of(out)


def read(manifest: DataFrame, seed: int | None = None) -> DataFrame:
    """Every record (DOCUMENTS), found through the index and checked; with a seed in shuffled order.

    ``start`` counts the ids of all documents before it over all files: the files' sums are added up in the manifest,
    which has one row a file.
    """
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = manifest.withColumn("before", before).withColumn("lo", F.explode(F.expr(f"sequence(0L, records - 1, {CHUNK}L)")))
    order = F.xxhash64("part", "lo") if seed is None else F.xxhash64("part", "lo", F.lit(seed))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chunks.repartition(parts, order).sortWithinPartitions(order).mapInArrow(lambda batches: _read(batches, seed), DOCUMENTS)
