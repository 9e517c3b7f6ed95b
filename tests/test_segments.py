import json

from panelspark.operators.segments import join_segments, read_notebooks, split_segments

CELLS = [
    ("markdown", "# Title\nplain\n\nmore"),
    ("code", "x = 1\n\ny = 2\n"),
    ("raw", "ignored"),
    ("code", ""),
    ("markdown", "last"),
]
TEXT = (
    "# --- Markdown Cell ---\n# Title\n# plain\n# \n# more\n"
    "# --- Code Cell ---\nx = 1\n\ny = 2\n\n"
    "# --- Code Cell ---\n\n"
    "# --- Markdown Cell ---\n# last\n"
)


def segments(spark):
    return spark.createDataFrame([("d", i, k, t) for i, (k, t) in enumerate(CELLS)], "doc string, pos long, kind string, text string")


def test_join(spark):
    assert join_segments(segments(spark)).first()["text"] == TEXT
    only_code = join_segments(segments(spark), include_markdown=False).first()["text"]
    assert "Markdown" not in only_code and only_code.startswith("# --- Code Cell ---\nx = 1")


def test_parts_give_the_same_text(spark):
    rows = join_segments(segments(spark), part_segments=2).orderBy("part").collect()
    assert len(rows) == 3 and "".join(r["text"] for r in rows) == TEXT


def cells(df):
    out = {}
    for r in df.orderBy("doc", "cell", "part").collect():
        kind, text = out.get(r["cell"], (r["kind"], None))
        out[r["cell"]] = (kind, r["text"] if text is None else text + "\n" + r["text"])
    return list(out.values())


WANT = [("markdown", "# Title\n# plain\n# \n# more"), ("code", "x = 1\n\ny = 2"), ("markdown", "# last")]


def test_split(spark):
    whole = spark.createDataFrame([("d", 0, "\nfirst = 0\n\n" + TEXT)], "doc string, part long, text string")
    assert cells(split_segments(whole)) == [("code", "first = 0"), *WANT]


def test_split_a_segment_over_several_parts(spark):
    text = "\n\na\n" + TEXT
    lines = text.splitlines(keepends=True)
    rows = [("d", i // 3, "".join(lines[i:i + 3])) for i in range(0, len(lines), 3)]
    parts = spark.createDataFrame(rows, "doc string, part long, text string")
    assert cells(split_segments(parts)) == [("code", "a"), *WANT]


def test_read_notebooks(spark, tmp_path):
    book = {"cells": [{"cell_type": k, "source": t.splitlines(keepends=True)} for k, t in CELLS], "nbformat": 4}
    (tmp_path / "a.ipynb").write_text(json.dumps(book))
    got = join_segments(read_notebooks(spark, str(tmp_path))).first()
    assert got["text"] == TEXT
