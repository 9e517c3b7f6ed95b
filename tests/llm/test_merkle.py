"""Merkle manifest and witnesses against a plain tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from panelspark.llm import merkle, queries
from panelspark.llm.common import table
from tests.llm import helpers as H
from tools.check import compare


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        a = levels[-1]
        levels.append([sha(*a[i:i + 2]) for i in range(0, len(a), 2)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        found += level[at ^ 1:(at ^ 1) + 1]
        at //= 2
    return found


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain(rows):
    """Contract of the query over (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for r in rows:
        changed = r.n_chars
        if r.doc_id is not None and changed is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0:
            changed += 1
        leaf, seen = (sha(*map(field, (r.doc_id, r.source, r.lang, n, r.text))) for n in (r.n_chars, changed))
        groups[r.lang].append((r.doc_id is not None, r.doc_id, leaf, seen))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for i, g in enumerate(langs):
        for at, (_, doc, leaf, seen) in enumerate(sorted(groups[g])):
            inner, outer = siblings(trees[g], at), siblings(top, i)
            node, k = seen, 0
            for levels, place in ((trees[g], at), (top, i)):
                for level in levels[:-1]:
                    other = level[place ^ 1:(place ^ 1) + 1]
                    node = sha(*(other + [node] if place % 2 else [node] + other))
                    place //= 2
            root = top[-1][0]
            out.append((doc, leaf, trees[g][-1][0], root, sha(*inner, *outer), node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("block", [2, 4, 4096])
def test_query_equals_plain_tree(spark, block, monkeypatch, tmp_path):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rng = random.Random(block)
    langs = [None] + ["en"] * 60 + ["de"] * 5 + ["", "é", "zz", "日"] + ["fr"] * 8
    rows = [(i if i % 9 else None, rng.choice([None, "", "a", "ä" * 3, "x" * 50_000]), x, rng.choice([None, "s"]), rng.choice([None, 0, 7]))
            for i, x in enumerate(langs)]
    rows += rows[10:14] + [(11, "other", "en", "s", 1)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, H.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    # Worker processes import the module anew, so small blocks are set by hand there.
    monkeypatch.setattr(merkle, "_append", appender(block))
    docs = table(spark, str(tmp_path), "documents")
    got = queries.op11_merkle_manifest(spark, str(tmp_path)).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs.collect())


def appender(block):
    original = merkle._append
    return lambda batches: _with(block, original, batches)


def _with(block, original, batches):
    from panelspark.llm import merkle as here

    here.BLOCK = block
    try:
        yield from original(batches)
    finally:
        here.BLOCK = 4096


def test_appender_equals_plain_tree():
    for n in range(1, 70):
        leaves = [sha(str(i)) for i in range(n)]
        levels, a = tree(leaves), merkle.Appender()
        for x in leaves:
            a.append(bytes.fromhex(x))
        root = a.close((n - 1).bit_length())
        assert root.hex() == levels[-1][0]
        for i, w in enumerate(a.witnesses):
            assert merkle.partners(bytes(w)).decode() == "".join(siblings(levels, i))
            assert merkle.fold(bytes.fromhex(leaves[i]), bytes(w)) == root


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "g", sha("a"), 5, "w"), (2, "g", None, 6, None), (3, None, sha("b"), 7, "v")],
                               "at long, lang string, leaf string, ROOT int, witness string")
    found = merkle.manifest(df, "leaf", "lang", ["at"])
    assert found.columns == [*df.columns, "_witness", "subroot", "_root"]
    checked = merkle.verify(found, "leaf", "_witness").collect()
    assert len(checked) == 3 and all(r["folded_root"] == r["_root"] for r in checked)
    assert merkle.verify(merkle.manifest(df.limit(0), "leaf", "lang", ["at"]), "leaf", "_witness").count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{H.FOLDER}/documents.parquet'")
    df = queries.op11_merkle_manifest(spark, H.FOLDER)
    assert compare(df, con, queries.ORACLES["op11_merkle_manifest"]) is None
    assert {r["verified"] for r in df.select(F.col("verified")).distinct().collect()} == {True, False}
