"""BPE, token records, WARC, nearest neighbours, chat, language model."""

import base64
import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelspark.llm import bpe, chat, mixing, queries, records, rotated_codes, warc
from panelspark.llm.common import table
from tests.llm import helpers as H

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n  x", "don't  stop here 　 12345 日本語 🙂🙂", "a" * 3000, "ab" * 1500 + "\x1c \x85z", "İß ſ K"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merge_equals_plain_search():
    rng = random.Random(4)
    ranks = {bytes([c]): c for c in range(97, 103)}
    pool = list(ranks)
    while len(ranks) < 60:
        new = rng.choice(pool) + rng.choice(pool)
        if new not in ranks:
            ranks[new] = 200 + len(ranks)
            pool.append(new)

    def plain(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while piece not in ranks:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts] if piece not in ranks else [ranks[piece]]

    for n in [*range(1, 40), 200]:
        piece = bytes(rng.choice(range(97, 103)) for _ in range(n))
        assert bpe.merge(piece, ranks) == plain(piece)


def test_bpe_equals_the_library_and_decodes(spark, library):
    rng = random.Random(6)
    made = ["".join(chr(rng.choice([32, 32, 97, 65, 10, 39, 115, 0xE9, 0x4E2D, 0x301, 0x1F600, rng.randrange(33, 0x2FFF)])) for _ in range(60)) for _ in range(60)]
    texts = ODD + made + [r["text"] for r in table(spark, H.FOLDER, "documents").limit(80).collect()]
    df = H.documents(spark, texts).withColumn("IDS", F.lit("x")).withColumn("_text", F.lit(2))
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == [*df.columns, "_ids"]
    for r in bpe.decode(coded, RANKS, public_tokenizers.PATTERN, ids="_ids").collect():
        t = texts[r["doc_id"]] or ""
        assert list(r["_ids"]) == library.encode_ordinary(t) and bytes(r["decoded"]) == t.encode()
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_records(spark, tmp_path):
    texts = ODD + ["<|endoftext|> <|ENDOFTEXT|>A", "b"] + [r["text"] for r in table(spark, H.FOLDER, "documents").limit(60).collect()]
    ids = [9 - i if i < 10 else i for i in range(len(texts))]
    ids[20], ids[21] = None, ids[22]
    manifest = records.write(H.documents(spark, texts, ids).repartition(3), WORD_BPE, end=1, folder=f"file://{tmp_path}/records")
    rows = records.read(manifest, seed=3).collect()
    encode = Tokenizer.from_file(WORD_BPE).encode
    expected = defaultdict(list)
    for i, t in zip(ids, texts):
        expected[i].append(encode(t or "", add_special_tokens=False).ids + [1])
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at and list(r["ids"]) in expected[r["doc_id"]]
        at += len(r["ids"])
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order[0] is None and order[1:] == sorted(order[1:]) and len(rows) == len(texts)
    empty = records.write(H.documents(spark, []), WORD_BPE)
    assert records.read(empty).count() == 0
    assert records.parse_payload(records.payload_of(None, np.array([1, 70000], "<u4").tobytes()))[0] is None


def test_damaged_record():
    import io
    good = records.frame(b"payload")
    assert records.read_frame(io.BytesIO(good)) == b"payload"
    for at in (0, 9, 14, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(bad)))


PAGES = "page_id long, url string, html string"


def test_warc(spark):
    big, small = "é" * 600, "y" * 999
    rows = [(1, "http://www.A.example.org:80/x?y#z", big), (2, None, big), (3, "https://u:p@b.example.org", small), (4, "no scheme\r\nX: 1", small),
            (5, "http://c.example.org/", None), (None, "http://d.example.org/", big), (6, "http://c.example.org/", "z" * 2000),
            (7, "http://c.example.org/", "z" * 2000), (7, "http://c.example.org/", "z" * 2000)]
    rows += [(100 + i, f"http://hot.example.net/{i % 7}", f"page {i}") for i in range(600)]
    df = spark.createDataFrame(rows, PAGES).withColumn("key", F.lit(0)).withColumn("digest", F.lit(0))
    index = warc.build_index(warc.write(df))
    keys = df.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    got = warc.read(index, keys).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    largest = {big: 2, "z" * 2000: 7}
    for r in got:
        html = next(h for i, _, h in rows if i == r["page_id"]) or ""
        data = html.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        first = largest.get(html)
        revisit = first is not None and first != r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("revisit", first) if revisit else ("response", None))
        assert (bytes(r["payload"]) if not revisit else r["payload"]) == (None if revisit else data)
    assert warc.read(index, spark.createDataFrame([("none",), ("",), ("~",)], "key string")).count() == 0
    empty = df.limit(0)
    assert warc.read(warc.build_index(warc.write(empty)), keys.limit(0)).count() == 0


def test_reversed_host_key(spark):
    df = spark.createDataFrame([("http://www.A.example.org:80/x?y",), (None,), ("x y",), ("https://u@b.org",)], "url string")
    assert [r[0] for r in df.select(warc.reversed_host_key(F.col("url"))).collect()] == ["org,example,a,www)/x?y", ")", ")x+y", "org,b)"]


def test_index_blocks_and_runs_of_equal_keys(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 3)
    lines = [(f"k{i // 5:03d}", f"file{i}", i, 1) for i in range(60)]
    files = []
    for part in (lines[:17], lines[17:42], lines[42:]):
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], names=["key", "file", "offset", "length"])
        files += [tuple(r.values()) for b in warc._blocks(iter([batch]), str(tmp_path)) for r in b.to_pylist()]
    index = warc.CaptureIndex(files)
    for k in range(12):
        assert sorted(index.lookup(f"k{k:03d}".encode())) == sorted(x[1:] for x in lines if x[0] == f"k{k:03d}")
    assert list(index.lookup(b"k0005")) == [] and list(index.lookup(b"")) == [] and list(index.lookup(b"z")) == []
    assert os.listdir(tmp_path)


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(8)
    vectors = {i: rng.standard_normal(16).astype(np.float32).tolist() for i in range(400)}
    for i in range(200, 230):
        vectors[i] = vectors[0]  # equal vectors: ties by id
    vectors[60] = (np.array(vectors[50]) * 3).astype(np.float32).tolist()
    odd = {400: None, 450: [0.0] * 16, 500: [1.0, None] + [0.0] * 14, 550: [float("nan")] * 16, 600: [float("inf")] * 16, 650: [1.0, 2.0], 651: [1.0, 1.0], 700: []}
    rows = [(i, v, 0) for i, v in {**vectors, **odd}.items()] + [(None, vectors[1], 0), (3, vectors[3], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code int")
    got = defaultdict(list)
    for r in rotated_codes.search(df, F.expr("id % 50 = 0"), k=5).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in range(0, 400, 50)} | {650}
    right = 0
    for q in range(0, 400, 50):
        a = np.array(vectors[q], float)
        scores = sorted((-float(a @ np.array(v, float) / np.linalg.norm(a) / np.linalg.norm(np.array(v, float))), i) for i, v in vectors.items() if i != q)
        near = sorted(got[q])
        assert [r for r, _, _ in near] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in near] == sorted((s for _, _, s in near), reverse=True)
        right += len({i for _, i in scores[:5]} & {v for _, v, _ in near})
    assert right >= 0.9 * 40 and [v for _, v, _ in sorted(got[0])] == [200, 201, 202, 203, 204]
    assert got[650] == [(1, 651, pytest.approx(3 / math.sqrt(10)))]
    assert rotated_codes.search(df.limit(0), F.expr("id % 50 = 0")).count() == 0


TURNS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|", "\\", "<", "|", "a\nb", "", None, "<|image|>", "<<|im_start|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)]
    rows += [(2, 5, "user", "b"), (2, 5, "user", "a"), (2, None, "a\\n\nb<|", "first"), (None, 1, None, "x"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same")]
    df = spark.createDataFrame(rows, TURNS).withColumn("head", F.lit(1)).withColumn("learned", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_large_conversation_ids_beside_a_null(spark):
    rows = [(9007199254740992, 0, "user", "a"), (9007199254740993, 0, "user", "b"), (9007199254740993, 1, "assistant", "c"), (None, 0, "user", "d")]
    got = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, TURNS).coalesce(1))).collect()
    assert {r["conv_id"]: r["n_turns"] for r in got} == {9007199254740992: 1, 9007199254740993: 2, None: 1}


def test_chat_parts(spark):
    part = lambda kind, text=None, **k: (kind, text, k.get("uri"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    parts = [part("text", "see <"), part("text", "|im_end|>"), part("image", uri="i.png", width=56, height=29), part("text", "and"),
             part("audio", uri="a.wav", seconds=1.5), part("document", uri="d.pdf", pages=2), part("image"), part(None, "tail"), part("video", "v")]
    df = spark.createDataFrame([(1, 0, "user", None, parts), (1, 1, "assistant", None, None)], f"{TURNS}, parts array<{chat.PART}>")
    first, second = chat.format_conversations(df, "parts").orderBy("turn_index").collect()
    assert first["formatted"] == "<|im_start|>user\nsee <\\|im_end|><|image|>and<|audio|><|document|><|image|>tailv<|im_end|>\n"
    assert [(a["type"], a["uri"], a["tokens"]) for a in first["attachments"]] == [
        ("image", "i.png", 4), ("audio", "a.wav", 38), ("document", "d.pdf", 1024), ("image", None, 1)]
    assert second["attachments"] == [] and (second["loss_start"], second["loss_end"]) == (22, 22)


def test_chat_query_visits_parts(spark, monkeypatch):
    visited, flatten = [], chat.flatten
    monkeypatch.setattr(chat, "flatten", lambda parts: visited.append(1) or flatten(parts))
    got = queries.op10_chat_formatting(spark, H.FOLDER).filter("conv_id < 0").collect()
    text = "<|im_end|><|im_start|>assistant ok"
    assert visited and [(r["n_turns"], r["loss_chars"], r["formatted_chars"]) for r in got] == [(2, len(text), 48 + 13 + 2 * len(text) + 4)]


def test_mixing_is_a_probability():
    words = [b"\x01the", b"\x01then", b"\x02der", b"\x00\n", b"\x01" + b"q" * 150]
    counts = np.array([50, 9, 20, 12, 1])
    sums = np.zeros((mixing.SLOTS, 2), np.float32)
    b = mixing.unpack(words)
    for _, node, bit in mixing.bits_of(b.data):
        for at in mixing.slots(mixing.contexts(b), node):
            np.add.at(sums, (at, bit.astype(int)), counts[b.word])
    halves = mixing.halves(sums.T)
    model = mixing.Model(halves[0], halves[1], mixing.fresh_weights(), mixing.fresh_cells())
    for k in range(20):
        mixing.learn(model, words, counts, k, np.zeros((2, mixing.CELLS)))
    # All tokens of up to one byte, and all first bytes of longer ones, share one unit of probability.
    one_byte = 10 ** mixing.score_words(model, [b"\x01" + bytes([c]) for c in range(256) if c not in b" \t\n\x0b\x0c\r"])
    assert 0 < one_byte.sum() + 10 ** mixing.score_words(model, [b"\x01\n"])[0] < 1
    known, unknown = mixing.score_words(model, [b"\x01the", b"\x01xzv"])
    assert known > unknown


def test_language_model(spark):
    df = table(spark, H.FOLDER, "documents").select("doc_id", "text")
    more = spark.createDataFrame([(5000, None), (5001, ""), (5002, "Zyxé zyXé"), (None, "the"), (5003, "w" * 5000)], "doc_id long, text string")
    copies = df.filter("doc_id = 3").withColumn("doc_id", F.lit(6000).cast("long"))
    df = df.unionByName(more).unionByName(copies).unionByName(copies).withColumn("row", F.lit(1)).withColumn("token", F.lit(1))
    rows = mixing.score(df).collect()
    source = df.collect()
    assert len(rows) == len(source)
    tokens = lambda t: H.words(H.lower(t)) + ["\n"]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c = Counter(w for r in source if not out(r["doc_id"]) for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    texts = {r["doc_id"]: r["text"] for r in source}
    for r in rows:
        w = tokens(texts[r["doc_id"]])
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(r["doc_id"]), len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0 and math.isfinite(r["score"])
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(round(r["score"], 6))
    assert by[6000] == by[3] and by[5000] == by[5001]
    held = [r for r in rows if r["held_out"]]
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(r["n_bytes"] for r in held)
    assert bits < 3.5  # five bits a byte would be letters drawn evenly
    assert mixing.score(df.limit(0)).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, 14))
