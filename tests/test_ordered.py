"""Blockwise ordered work equals the plain definition, whatever the block size."""

import random

from pyspark.sql import functions as F

from parchline.operators.chunks import fixed_table, structured_table
from parchline.operators.ordered import concat_ordered, running
from parchline.operators.sections import apply_failure_policy, heading_table, page_table, row_table

from .test_text import windows


def parts(seed=7, docs=3, longest=40):
    rng = random.Random(seed)
    return [
        (f"d{d}", p, "".join(rng.choice("ab \n") for _ in range(rng.randrange(12))), rng.random() < 0.3)
        for d in range(docs)
        for p in range(rng.randrange(1, longest))
    ]


def test_running(spark):
    rows = parts()
    frame = spark.createDataFrame(rows, "doc string, pos int, text string, flag boolean")
    found = running(
        frame, ["doc"], "pos", sums={"before": F.length("text")}, lasts={"latest": F.when(F.col("flag"), F.col("pos"))}, block_rows=4
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        own = [x for x in rows if x[0] == r["doc"]]
        assert r["before"] == sum(len(x[2]) for x in own if x[1] < r["pos"])
        assert r["latest"] == max((x[1] for x in own if x[3] and x[1] <= r["pos"]), default=None)


def test_concat_in_parts_is_whole(spark):
    rows = parts(11)
    frame = spark.createDataFrame(rows, "doc string, pos int, text string, flag boolean")
    whole = {d: "|".join(x[2] for x in sorted(rows, key=lambda x: x[1]) if x[0] == d) for d in {x[0] for x in rows}}
    one = {r["doc"]: r["text"] for r in concat_ordered(frame, ["doc"], "pos", "text", "|").collect()}
    assert one == whole
    cut = concat_ordered(frame, ["doc"], "pos", "text", "|", part_chars=20, block_rows=3).orderBy("doc", "part_no").collect()
    assert len(cut) > len(whole)
    joined = {}
    for r in cut:
        joined.setdefault(r["doc"], []).append(r["text"])
    assert {d: "|".join(p) for d, p in joined.items()} == whole


def test_concat_by_blocks_is_whole(spark):
    rows = [*parts(13), ("n", 0, None, False), ("n", 9, None, False), ("n", 10, "x", False), ("n", 30, "", False)]
    frame = spark.createDataFrame(rows, "doc string, pos int, text string, flag boolean")
    whole = {d: "|".join(x[2] for x in sorted(rows, key=lambda x: x[1]) if x[0] == d and x[2] is not None) for d in {x[0] for x in rows}}
    found = concat_ordered(frame, ["doc"], "pos", "text", "|", block_rows=3).collect()
    assert [r["part_no"] for r in found] == [0] * len(whole) and {r["doc"]: r["text"] for r in found} == whole


def test_long_sections_are_one_row_and_cut_as_one_text(spark):
    rows = spark.sql("SELECT 'd' AS doc, CAST(id AS int) AS pos, repeat(concat('p', id, ' '), 3000000) AS text FROM range(3)")
    found = heading_table(rows, "doc", "pos", "text", F.lit(False))
    whole = "\n".join(f"p{i} " * 2999999 + f"p{i}" for i in range(3))
    assert [(r["part_no"], r["text"] == whole) for r in found.collect()] == [(0, True)]
    chunks = structured_table(found, "doc", 1 << 20, 1 << 10).orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in chunks] == list(range(len(chunks)))
    assert [r["chunk_text"] for r in chunks] == windows(whole, 1 << 20, 1 << 10)


def test_fixed_windows_over_sections(spark):
    rows = parts(3)
    frame = page_table(spark.createDataFrame(rows, "doc string, pos int, text string, flag boolean"), "doc", "pos", "text")
    found = {(r["doc"], r["chunk_index"]): r["chunk_text"] for r in fixed_table(frame, "doc", 4, 1).collect()}
    expected = {}
    for doc in {x[0] for x in rows}:
        text = "\n\n".join(t for t in (x[2].strip() for x in sorted(rows, key=lambda x: x[1]) if x[0] == doc) if t)
        expected.update({(doc, i): p for i, p in enumerate(windows(text, 4, 1))} if text else {})
    assert found == expected


def test_heading_table(spark):
    # two headings in a row, heading last, text before the first heading, blanks between
    rows = [
        ("a", 0, "intro", False),
        ("a", 1, "H1", True),
        ("a", 2, "H2", True),
        ("a", 3, " one ", False),
        ("a", 4, "  ", False),
        ("a", 5, "two", False),
        ("a", 6, "H3", True),
        ("b", 0, "only text", False),
        ("c", 0, "H", True),
    ]
    frame = spark.createDataFrame(rows, "doc string, pos int, text string, h boolean")
    found = heading_table(frame, "doc", "pos", "text", F.col("h")).orderBy("doc", "position").collect()
    assert [(r["doc"], r["position"], r["heading"], r["text"]) for r in found] == [
        ("a", 0, None, "intro"),
        ("a", 1, "H2", "one\ntwo"),
        ("b", 0, None, "only text"),
    ]


def test_structured_table_numbers_over_the_document(spark):
    rows = [("a", 0, "x" * 40, None), ("a", 1, "", "h"), ("a", 2, "yy", "h")]
    frame = spark.createDataFrame(rows, "doc string, position int, text string, heading string")
    found = structured_table(frame, "doc", 4, 1).orderBy("chunk_index").collect()
    assert [r["chunk_index"] for r in found] == list(range(len(found)))
    assert found[-1]["chunk_text"] == "yy" and found[-1]["section_heading"] == "h"


def test_row_table_skips_blank_rows(spark):
    frame = spark.createDataFrame([(0, "a", None), (1, "", None), (2, None, 5)], "id int, x string, y int")
    found = row_table(frame, "t", "id", ["x", "y"]).orderBy("position").collect()
    assert [(r["position"], r["heading"], r["text"]) for r in found] == [(0, "t", "x: a"), (1, "t", "y: 5")]


def test_failure_policy(spark):
    rows = [("a", 0, True, "atomic"), ("a", 1, False, "atomic"), ("p", 0, True, "partial"), ("p", 1, False, "partial"), ("g", 0, False, "atomic")]
    frame = spark.createDataFrame(rows, "doc string, pos int, bad boolean, policy string")
    found = apply_failure_policy(frame, "doc", F.col("bad"), F.col("policy")).orderBy("doc").collect()
    assert [(r["doc"], r["pos"], r["is_partial"]) for r in found] == [("g", 0, False), ("p", 1, True)]
