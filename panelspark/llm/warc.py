"""WARC archives with a two-level capture index.

Every page becomes a record, a gzip member of its own. Of pages with equal payloads of at least LEAST bytes the one with
the largest page_id is written in full (response); the others (revisit) keep the HTTP header, the payload digest and the
record they refer to. Index lines (reversed-host URL key, page_id, file, offset, length) are sorted by ranges of the key;
each range is written as compressed blocks of LINES lines with a sparse directory behind them: first key, offset and length
of each block. A lookup finds the file by its first key, the block by binary search in that file's directory, reads that
range, the line by binary search in the block, and reads the record's range.

A task writes under names of its own attempt and only files of tasks that ended are listed. Null html counts as empty. A null
url has key ``)``; a null page_id is written as such and refers to a page with an id if there is one. A page_id that repeats
with the same payload is a response each time. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import struct
import uuid
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import store, text_of
from panelspark.sources.scratch import scratch_path

LEAST = 1000  # bytes of a payload that is worth a revisit record
LINES = 256  # index lines a block
ROLL = 1 << 28  # bytes after which a task starts another archive
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRIES = "key string, file string, offset long, length long"
FILES = "first string, file string, directory long, size long"
CAPTURES = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_TAIL = struct.Struct("<Q")


def reversed_host_key(url: Column) -> Column:
    """``org,example,www)/path?query``: host labels backwards, then the rest; without scheme, user and port."""
    url = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "+")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)).otherwise(url)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def capture_key(url: Column, page_id: Column) -> Column:
    return F.concat(reversed_host_key(url), F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("")))


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{b32encode(bytes.fromhex(digest)).decode()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The capture in one record; a response's payload is held against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    digest = b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(number) if number else None

    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "payload_bytes": size, "payload_digest": digest, "refers_to": page(fields.get("WARC-Refers-To")),
            "payload": payload if kind == "response" else None}


def _member(data: bytes) -> bytes:
    gz = zlib.compressobj(3, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


def _archive(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    files, base = FileSystem.from_uri(folder)
    out, name, offset = None, "", 0
    for batch in batches:
        entries = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "url", "payload", "digest", "first", "revisit"))):
            key, page_id, url, payload, digest, first, revisit = row
            if out is None or offset > ROLL:
                if out is not None:
                    out.close()
                files.create_dir(base, recursive=True)
                name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                out = files.open_output_stream(f"{base}/{name}", compression=None)
            data = _member(record(page_id, url, payload, digest, first, revisit, date))
            out.write(data)
            entries.append((key, f"{folder}/{name}", offset, len(data)))
            offset += len(data)
        if entries:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*entries), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "file", "offset", "length"])
    if out is not None:
        out.close()


def write(df: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", least: int = LEAST) -> DataFrame:
    """Write the archives of (page_id, url, html) to ``folder`` (default: fresh in the shared folder); returns the stored
    index lines (ENTRIES), not sorted."""
    folder = folder or scratch_path(df.sparkSession, "archives")
    page_id, url, html = F.col("page_id").cast("long"), F.col("url").cast("string"), text_of("html")
    pages = df.select(capture_key(url, page_id).alias("key"), page_id.alias("page_id"), url.alias("url"),
                      html.cast("binary").alias("payload"), F.sha1(html).alias("digest"))
    size = F.octet_length("payload")
    # Only payloads that repeat get a row here; hot ones are one row, and counted before the shuffle.
    shared = store(
        pages.filter(size >= least).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL").drop("n"), "shared-payloads")
    found = pages.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (size >= least)
    rows = found.select("key", "page_id", "url", "payload", "digest", "first", revisit.alias("revisit"))
    return store(rows.mapInArrow(lambda batches: _archive(batches, folder, date), ENTRIES), "index-lines")


def _blocks(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, base = FileSystem.from_uri(folder)
    out, name, offset, held, directory = None, "", 0, [], []

    def flush() -> int:
        data = zlib.compress("\n".join("\t".join(map(str, x)) for x in held).encode(), 6)
        out.write(data)
        directory.append(f"{held[0][0]}\t{offset}\t{len(data)}")
        held.clear()
        return len(data)

    for batch in batches:
        for line in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length"))):
            if out is None:
                files.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.cdx"
                out = files.open_output_stream(f"{base}/{name}", compression=None)
            if len(held) == LINES:
                offset += flush()
            held.append(line)
    if out is not None:
        offset += flush()
        data = zlib.compress("\n".join(directory).encode(), 6)
        out.write(data)
        out.close()
        yield pa.RecordBatch.from_pydict({"first": [directory[0].split("\t")[0]], "file": [f"{folder}/{name}"],
                                          "directory": [offset], "size": [len(data)]})


def build_index(entries: DataFrame, folder: str | None = None) -> DataFrame:
    """Sort the index lines into block files; returns the stored list of files (FILES), one row a range of keys."""
    spark = entries.sparkSession
    folder = folder or scratch_path(spark, "index")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartitionByRange(parts, "key").sortWithinPartitions("key", "file", "offset")
    return store(dealt.mapInArrow(lambda batches: _blocks(batches, folder), FILES), "index-files")


class CaptureIndex:
    """Lookups by key; keys that come in order read each directory and block once."""

    def __init__(self, files: list[tuple[str, str, int, int]]):
        self.files = sorted(files)
        self.first = [f[0].encode() for f in self.files]
        self.of_file: tuple[int, list, list] | None = None
        self.of_block: tuple[tuple[int, int], list, list] | None = None

    @staticmethod
    def _range(uri: str, offset: int, length: int) -> bytes:
        fs, path = FileSystem.from_uri(uri)
        with fs.open_input_file(path) as source:
            source.seek(offset)
            return source.read(length)

    def _directory(self, f: int) -> tuple[list, list]:
        if self.of_file is None or self.of_file[0] != f:
            _, uri, offset, size = self.files[f]
            rows = [x.split(b"\t") for x in zlib.decompress(self._range(uri, offset, size)).split(b"\n")]
            self.of_file = (f, [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows])
        return self.of_file[1:]

    def _block(self, f: int, b: int) -> tuple[list, list]:
        if self.of_block is None or self.of_block[0] != (f, b):
            offset, length = self._directory(f)[1][b]
            rows = [x.split(b"\t") for x in zlib.decompress(self._range(self.files[f][1], offset, length)).split(b"\n")]
            self.of_block = ((f, b), [r[0] for r in rows], rows)
        return self.of_block[1:]

    def lookup(self, key: bytes) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of every line with that key; a run of equal keys may go over blocks and files."""
        f = max(bisect.bisect_left(self.first, key) - 1, 0)
        while f < len(self.files) and self.first[f] <= key:
            firsts = self._directory(f)[0]
            b = max(bisect.bisect_left(firsts, key) - 1, 0)
            while b < len(firsts) and firsts[b] <= key:
                keys, rows = self._block(f, b)
                for r in rows[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]:
                    yield r[1].decode(), int(r[2]), int(r[3])
                b += 1
            f += 1


def read(index_files: DataFrame, keys: DataFrame, payloads: bool = True) -> DataFrame:
    """The captures (CAPTURES) of every key in ``keys`` (column key): index lookup, then a range read of the archive.

    The list of index files has one row a range partition, whatever the number of captures, and goes to every task; the
    directories stay in the files.
    """
    files = [tuple(r) for r in index_files.select("first", "file", "directory", "size").collect()]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(files)
        opened: dict = {}
        out, size = [], 0

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

        for batch in batches:
            for key in batch.column("key").cast(pa.binary()).to_pylist():
                for uri, offset, length in index.lookup(key):
                    if uri not in opened:
                        if len(opened) > 64:
                            opened.popitem()[1].close()
                        fs, path = FileSystem.from_uri(uri)
                        opened[uri] = fs.open_input_file(path)
                    opened[uri].seek(offset)
                    found = parse(zlib.decompress(opened[uri].read(length), 31))
                    if not payloads:
                        found["payload"] = None
                    out.append(found)
                    size += 500 + len(found["payload"] or b"")
                    if size > 1 << 22:
                        yield batch_of(out)
                        out, size = [], 0
        if out:
            yield batch_of(out)
        for source in opened.values():
            source.close()

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select("key").distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, CAPTURES)
