"""Quality rules, line dedup, SimHash, packing, the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelspark.llm import components, linededup, packing, quality, queries, simhash, wordtokens
from panelspark.llm.common import table
from tests.llm import helpers as H

LONG_LINE = "one two three four five six seven eight nine ten"
ODD = [None, "", " \n\t", "a b c a b c a b c", "x " * 60, "word " * 49 + " ", "p | q " * 40, "l1 a b\nl1 a b\nl2\n\nl1 a b",
       "héé " * 10 + "\x1c\x85 end", LONG_LINE, LONG_LINE]


def test_quality_metrics_and_verdicts(spark):
    texts = ODD + [r["text"] for r in table(spark, H.FOLDER, "documents").collect()]
    rows = quality.report(H.documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        m = H.metrics(texts[r["doc_id"]])
        assert {k: r[k] for k in m} == m
        base = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        bad = (10 * m["n_symbols"] > m["n_words"] or 2 * m["n_dup_lines"] > m["n_lines"]
               or not 2 * m["n_words"] <= m["word_chars"] <= 20 * m["n_words"])
        assert r["base_failed"] == base and r["kept"] == (not base and not bad)
        assert (r["rejected_by"] is None) == r["kept"]


def test_quality_keeps_columns_and_takes_empty_tables(spark):
    df = H.documents(spark, ODD + ["good words here in a row " * 3 + " ".join(f"w{i}" for i in range(80))])
    df = df.withColumn("REJECTED_BY", F.lit("own")).withColumn("w", F.lit(1))
    kept = quality.keep(df)
    assert kept.columns == df.columns and [r["REJECTED_BY"] for r in kept.collect()] == ["own"]
    assert quality.keep(df.limit(0)).count() == 0 and quality.report(df.limit(0)).count() == 0


def test_cascade_order_is_by_rejection_per_cost():
    a, b, c = (quality.Rule(n, None) for n in "abc")
    assert quality.order([(a, 0.1, 1.0), (b, 0.4, 2.0), (c, 0.0, 0.1)]) == [b, a, c]


def test_longest_aligned_run():
    rng = random.Random(1)
    for _ in range(50):
        pairs = sorted(zip(rng.sample(range(30), 12), rng.sample(range(30), 12)))
        best = [1] * 12
        for i in range(12):
            best[i] = 1 + max([best[j] for j in range(i) if pairs[j][1] < pairs[i][1]], default=0)
        found = linededup.aligned(pairs)
        assert len(found) == max(best) and all(pairs[x][1] < pairs[y][1] for x, y in zip(found, found[1:]))
    assert linededup.aligned([]) == []


def test_line_dedup(spark):
    passage = "\n".join(f"{LONG_LINE} {k}" for k in range(6))
    texts = [
        f"first text has its own opening line right here\n{passage}\nand an end of its own, long enough", passage,
        f"another start that no other text has\nyes\n{LONG_LINE} 0\n\n{LONG_LINE} 1\nyes", None, "", "short\nshort", "short\nother",
        f"{LONG_LINE} 5\n{LONG_LINE} 0", "\n".join([LONG_LINE + " again"] * 3), "\n".join([LONG_LINE + " again"] * 2)]
    got = {r["doc_id"]: r for r in linededup.dedup_lines(H.documents(spark, texts)).collect()}
    assert got[0]["text"] == texts[0] and got[0]["n_removed"] == 0
    assert got[1]["text"] == "" and got[1]["n_removed"] == 6 and got[1]["aligned_with"] == [0]
    assert got[2]["text"] == "another start that no other text has\nyes\n\nyes" and got[2]["n_removed"] == 2
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "short\nshort" and got[6]["text"] == "short\nother"
    assert got[7]["n_removed"] == 1  # only one of two lines in the other order can be aligned
    assert got[8]["n_removed"] == 0 and got[9]["text"] == ""


def test_line_dedup_hot_line_repeated_rows_and_columns(spark):
    hot = "this very line stands in every single document"
    texts = [f"{hot}\nown line number {i} of this document" for i in range(40)]
    df = H.documents(spark, texts + texts[:2] + [texts[5]], [*range(40), 0, 1, None]).withColumn("N_LINES", F.lit(7)).withColumn("key", F.lit(1))
    out = linededup.dedup_lines(df)
    assert out.columns[:7] == df.columns
    rows = out.collect()
    assert len(rows) == 43
    for r in rows:
        if r["doc_id"] is None:
            assert r["text"] == texts[5]  # comes first, so it stays whole
        else:
            assert hot not in r["text"] and (r["doc_id"] == 5 or "own line" in r["text"])
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_windows_of_short_lines():
    rng = random.Random(7)
    for _ in range(200):
        n = [rng.choice([0, 3, 11, 17, 29, 30, 70]) for _ in range(rng.randrange(15))]
        plain = []
        for i, own in enumerate(n):
            for j in range(i + 1, len(n) + 1):
                if not 0 < own or max(n[i:j]) >= linededup.LONG:
                    break
                if sum(n[i:j]) >= linededup.LONG:
                    plain.append((i, j - 1))
                    break
        assert list(linededup.windows(n)) == plain


def test_line_dedup_aligns_with_all_earlier_documents(spark):
    p, q = ("\n".join(f"{x} {LONG_LINE} {k}" for k in range(3)) for x in "pq")
    short = ["short rare line one", "short rare line two", "short rare line six"]
    swapped = [f"{p}\n{q}", f"{q}\n{p}", f"{q}\n{p}", f"{q}\nhere a line of its own\n{p}"]
    split = [f"{s}\nown text {k} of this document" for k, s in enumerate(short)] + ["\n".join([f"own start {k}", *short]) for k in range(2)]
    around = [f"around {LONG_LINE}", *(f"{short[0]} b\naround {LONG_LINE}\n{short[1]} b" for _ in range(2))]
    got = {r["doc_id"]: r for r in linededup.dedup_lines(H.documents(spark, swapped + split + around)).collect()}
    assert got[0]["text"] == swapped[0] and got[1]["n_removed"] == 3
    assert got[2]["text"] == "" and set(got[2]["aligned_with"]) == {0, 1}
    assert got[3]["text"] == "here a line of its own"
    assert [got[k]["n_removed"] for k in range(4, 9)] == [0, 0, 0, 0, 3] and got[8]["text"] == "own start 1" and got[8]["aligned_with"] == [7]
    assert [got[k]["n_removed"] for k in (9, 10, 11)] == [0, 1, 3]


@pytest.mark.parametrize("ordered", [True, False])
def test_line_dedup_against_alignment_of_all_pairs(spark, ordered):
    """Passages of long and of short lines. In one order the results are those of aligning each text with all earlier ones; else
    no line may vanish from the corpus, and what two texts still share must be crossed by something else that they shared."""
    rng = random.Random(11)
    passages = [[f"{x} {LONG_LINE} {k}" for k in range(2)] for x in "abcd"] + [[f"{x} verse {k} of song" for k in range(3)] for x in "efgh"]
    texts, orders = [], []
    for i in range(30):
        chosen = rng.sample(range(8), rng.randrange(1, 6))
        orders.append(sorted(chosen) if ordered else chosen)
        texts.append([f"own line of document {i} here"] + [y for x in orders[-1] for y in passages[x] + [""]])
    rows = sorted(linededup.dedup_lines(H.documents(spark, ["\n".join(t) for t in texts])).collect(), key=lambda r: r["doc_id"])
    lines = [[y for y in r["text"].split("\n") if y] for r in rows]
    kept: list[list[str]] = []
    for t in texts:
        rest = [y for y in t if y]
        for earlier in kept:
            common = sorted((a, b) for a, x in enumerate(earlier) for b, y in enumerate(rest) if x == y)
            gone = {common[i][1] for i in linededup.aligned(common)}
            rest = [y for b, y in enumerate(rest) if b not in gone]
        kept.append(rest)
    assert {y for x in lines for y in x} == {y for x in texts for y in x if y}
    if ordered:
        assert lines == kept
    for i, b in enumerate(orders):
        for j, a in enumerate(orders[:i]):
            for x in set(a) & set(b):
                if passages[x][0] in lines[i] and passages[x][0] in lines[j]:
                    assert any((a.index(x) < a.index(y)) != (b.index(x) < b.index(y)) for y in set(a) & set(b) - {x})


@pytest.mark.parametrize("copies", [3, 20])
def test_line_dedup_short_lines_at_any_frequency(spark, copies):
    verse = "\n".join(["roses are red", "violets are blue", "", "sugar is sweet"])
    texts = [f"own line {i} of this document\n{verse}" for i in range(copies)]
    rows = linededup.dedup_lines(H.documents(spark, texts)).collect()
    assert all(r["n_removed"] == (4 if r["doc_id"] else 0) for r in rows)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {"path": [(i, i + 1) for i in range(200)], "star": [(0, i) for i in range(1, 300)],
             "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]}[shape]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links + links[:3] + [(None, 5)], "a long, b long")).collect()}
    nodes = {n for a, b in links for n in (a, b) if a != b}
    assert got == H.components(nodes, [x for x in links if x[0] != x[1]])
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_connect_what_all_links_connect(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)  # so that large cells are cut
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(150)}
    for centre in (0, (1 << 64) - 1, rng.getrandbits(64)):  # dense balls
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(150)}
    values = sorted(values)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = simhash.links(spark.createDataFrame(rows, "fp long")).collect()
    unsigned = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= 4 for a, b in unsigned)
    every = [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 4]
    assert H.components(values, unsigned) == H.components(values, every)


def test_simhash(spark):
    base = [r["text"] for r in table(spark, H.FOLDER, "documents").limit(60).collect()]
    rng = random.Random(2)
    long = [f"w{i % 97}x{i}" for i in range(900)]
    near = []
    for _ in range(25):
        copy = list(long)
        copy[rng.randrange(900)] = "changed"
        near.append(" ".join(copy))
    texts = base + near + [base[3]] * 4 + ["", None, " \n", "one two", "ONE  two", "one two three four"]
    ids = [*range(len(texts) - 1), None]
    rows = simhash.near_duplicates(H.documents(spark, texts, ids)).collect()
    prints = [H.fingerprint(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = H.components(range(len(texts)), links)
    assert len(rows) == len(texts)
    for r in rows:
        i = len(texts) - 1 if r["doc_id"] is None else r["doc_id"]
        assert r["fp"] % (1 << 64) == prints[i]
        assert r["component_id"] == (ids[label[i]])
    kept = simhash.keep_one(H.documents(spark, texts, ids).withColumn("fp", F.lit(1)))
    chosen = [r["doc_id"] for r in kept.collect()]
    assert "fp" in kept.columns and len(chosen) == len(set(chosen))
    assert set(chosen) == {ids[x] for x in label.values()} | {None}
    assert simhash.near_duplicates(H.documents(spark, [])).count() == 0


def test_one_id_in_two_groups(spark):
    """Documents that share an id are told apart by their texts; only near-duplicates go."""
    first, second = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    df = H.documents(spark, [first, second, second, second, None], [5, 5, 5, 9, 5]).withColumn("text_hash", F.lit(1)).withColumn("keep_id", F.lit(2))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(5, ""), (5, first), (5, second)]


def test_line_dedup_keeps_columns_of_its_own_names(spark):
    block = "a line that is long enough to count\nanother line that is long enough too"
    df = H.documents(spark, [block, f"x\n{block}\ny"]).withColumns({"_id": F.lit(1), "_key": F.lit(2), "_removed": F.lit(3), "D": F.lit(4)})
    rows = {r["doc_id"]: r for r in linededup.dedup_lines(df).collect()}
    assert rows[1]["text"] == "x\ny" and rows[1]["n_removed"] == 2 and (rows[1]["_id"], rows[1]["_key"], rows[1]["_removed"]) == (1, 2, 3)


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_large_ids_beside_a_null(spark):
    big = [9007199254740993, 9007199254740995, None, 9007199254740997]
    rows = packing.pack(H.documents(spark, ["a b", "c", "d", "e f g"], big).coalesce(1), WORD_BPE).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 2), (big[0], 3), (big[1], 2), (big[3], 4)]


def test_plain_words_skip_normalizing_only_where_it_changes_nothing():
    library, rng = Tokenizer.from_file(WORD_BPE), random.Random(5)
    pool = [32, 32, 10, 97, 98, 65, 72, 84, 39, 115, 46, 33, 48, 0x331, 0x308, 0x130, 0x212A, 0xC9, 0x4E2D, 0x1F600, 0xA0, 0x85, 60, 124, 62, 0x3A3]
    texts = ["".join(map(chr, rng.choices(pool, k=rng.randrange(40)))) + rng.choice(["", "<|startoftext|>", "<|endoftext|> x"]) for _ in range(3000)]
    found = wordtokens.encode_texts([x.encode() for x in texts], WORD_BPE)
    assert [np.frombuffer(b, np.uint32).tolist() for b in found] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_cut():
    for n in [*range(1, 9000), 123_456]:
        pieces = packing.cut(n)
        assert sum(pieces) == n and max(pieces) <= 4096 and min(pieces) > 0


def test_chunks_that_compose_in_lower_case_only():
    library = Tokenizer.from_file(WORD_BPE)
    words = [x + "ayr" for x in ("H\u0331", "T\u0308", "W\u030a", "Y\u030a", "J\u030c", "E\u0301", "\u00c9", "\u0130")]
    texts = ["ABC " + w + ", Abc" for w in words] + [" ".join(words), "PLAIN Words.", "<|x|> H\u0331ayr Abc"]
    found = wordtokens.encode_texts([x.encode() for x in texts], WORD_BPE)
    assert [np.frombuffer(b, np.uint32).tolist() for b in found] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_packing(spark):
    texts = [r["text"] for r in table(spark, H.FOLDER, "documents").collect()] + [None, "", "a", "<|endoftext|> é́ x\x1cy", "long word " * 9000]
    ids = [*range(len(texts) - 1), None]
    df = H.documents(spark, texts, ids).withColumn("ids", F.lit(3)).repartition(5)
    pieces = packing.pack(df, WORD_BPE).collect()
    library = Tokenizer.from_file(WORD_BPE)
    expected = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in zip(ids, texts)}
    for i, whole in expected.items():
        own = sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"])
        assert [x for r in own for x in r["ids"]] == whole
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:k]) for k in range(len(own))]
    bins = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 4096 - at if at & (at - 1) else 0
    assert padding < 0.03 * sum(map(len, expected.values())) + 4096
    whole = packing.sequences(packing.pack(df, WORD_BPE), pad=0).collect()
    assert all(len(r["ids"]) == 4096 or len(r["ids"]) == r["n_tokens"] and r["n_tokens"].bit_count() == 1 for r in whole)
    assert packing.pack(df.limit(0), WORD_BPE).count() == 0


def test_pipeline(spark):
    """Each stage against brute force over what the one before it kept."""
    docs = table(spark, H.FOLDER, "documents")
    columns = docs.columns
    kept = corpus_pipeline.quality_rules(spark, docs, H.FOLDER)
    verdict = {r["doc_id"]: r["kept"] for r in quality.report(docs).collect()}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in verdict.items() if k}
    cut = corpus_pipeline.line_dedup(spark, kept, H.FOLDER)
    before = {r["doc_id"]: r for r in kept.collect()}
    after = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == columns and after.keys() == before.keys()
    seen = set()
    for i in sorted(after):
        left = after[i]["text"].split("\n") if after[i]["text"] or not before[i]["text"] else []
        lines = before[i]["text"].split("\n")
        rest = iter(lines)
        assert all(x in rest for x in left)  # what stays stays in order
        gone = len(lines) - len(left)
        assert not gone or any(len(x) >= 30 and x in seen for x in lines)
        assert all(x in left for x in lines if len(x) >= 30 and x not in seen)
        seen.update(lines)
    one = corpus_pipeline.simhash_near_dedup(spark, cut, H.FOLDER)
    prints = {i: H.fingerprint(r["text"]) for i, r in after.items()}
    links = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 4]
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == set(H.components(prints, links).values())
    library = Tokenizer.from_file(WORD_BPE)
    got = {}
    for r in corpus_pipeline.run(spark, H.FOLDER).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in got.items()} == {
        r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids + [2] for r in one.collect()}


def test_crc(spark):
    rows = queries.with_crc(spark.createDataFrame([(1, [1, 2, 70000]), (2, [])], "doc_id long, ids array<int>")).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in rows} == {1: zlib.crc32(np.array([1, 2, 70000], "<u4").tobytes()), 2: 0}


def test_packing_query(spark):
    """Every document's ids by the library, cut as the pieces say."""
    library = Tokenizer.from_file(WORD_BPE)
    whole = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in table(spark, H.FOLDER, "documents").collect()}
    rows = queries.op6_harmonic_packing(spark, H.FOLDER).collect()
    seen = {i: 0 for i in whole}
    for r in rows:
        ids = whole[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and r["doc_tokens"] == len(whole[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen[r["doc_id"]] += r["length"]
    assert seen == {i: len(x) for i, x in whole.items()}
