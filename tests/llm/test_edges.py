"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing extra columns."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from parchline.llm import byte_bpe, chat, decontaminate, jaccard_join, line_dedup, pii, quality, rans, topk, url_filter

LONG = "lorem ipsum dolor sit amet consetetur " * 3000
LINE = "one two three four five six seven eight nine ten eleven twelve"
#: Extra columns named like those that operators add.
SCHEMA = "doc_id long, text string, row string, n_chars long, n_words long, score double, id long, ids string, removed int"
ROWS = [
    (1, LINE, "r", 5, 1, 0.5, 9, "x", 1),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "r", 0, 1, 0.5, 9, "x", 1),
    (4, LINE, "r", 5, 1, 0.5, 9, "x", 1),
    (4, LINE, "r", 5, 1, 0.5, 9, "x", 1),
    (None, LINE, "r", 5, 1, 0.5, 9, "x", 1),
    (5, LONG, "r", 5, 1, 0.5, 9, "x", 1),
    (6, "a.b@c.de 12", "r", 5, 1, 0.5, 9, "x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(docs, none):
    found = [r for r in line_dedup.deduplicated(docs).collect()]
    assert len(found) == len(ROWS)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["text"], r["n_removed"]))
    assert by[1] == [(LINE, 0)] and by[2] == [(None, 0)] and by[3] == [("", 0)]
    assert by[4] == [("", 1), ("", 1)] and by[None] == [("", 1)]
    assert line_dedup.deduplicated(none).count() == 0


def test_jaccard_join(docs, none):
    found = sorted(map(tuple, jaccard_join.near_duplicates(docs).collect()), key=str)
    assert found == sorted(
        [(1, 8, 1), (2, 0, 2), (3, 0, 3), (4, 8, 1), (4, 8, 1), (None, 8, None), (5, 6, 5), (6, 1, 6)], key=str
    )
    assert jaccard_join.near_duplicates(none).count() == 0
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 6]


def test_url_filter(spark):
    pages = spark.createDataFrame(
        [(1, None, "h"), (2, "no scheme", "h"), (3, "http://X.example.NET/en/a?b", "h"), (3, "http://x.org/fr", "h"), (None, "s://h#f/x", "h")],
        "page_id long, url string, host string",
    )
    outcomes = spark.createDataFrame([(3, 1), (3, None), (None, 1), (1, 0)], "page_id long, bad int")
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow")]
    found = sorted(map(tuple, url_filter.judged(pages, outcomes, rules).select("page_id", "host", "path", "rule").collect()), key=str)
    assert found == sorted(
        [(1, "", "", None), (2, "", "", None), (3, "x.example.net", "/en/a", "example.net/en/"), (3, "x.org", "/fr", None), (None, "h", "", None)], key=str
    )
    assert {r["verdict"] for r in url_filter.judged(pages, outcomes.limit(0), []).collect()} <= {"allow", "block"}
    assert url_filter.judged(pages.limit(0), outcomes, rules).count() == 0


def test_url_reputation_follows_labels(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.example.com/{i}") for i in range(200)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i % 2) for i in range(120)], "page_id long, bad int")
    found = {(r["host"], r["verdict"]) for r in url_filter.judged(pages, outcomes, []).collect()}
    assert found == {("bad.example.com", "block"), ("good.example.com", "allow")}


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 0, 0), (None, 1, 0), (6, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        machine = quality.train(docs, given)
        found = quality.scored(docs, machine)
        assert found.columns == ["row", "score"] and found.count() == len(ROWS)
        assert found.filter("score is null or score < 0 or score > 1").count() == 0
    assert {r["score"] for r in quality.scored(docs, quality.train(none, labels)).collect()} == {0.5}
    assert quality.kept_by_quality(docs, labels, least=0.0).columns == docs.columns
    assert quality.scored(none, machine).count() == 0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame(
        [(1, LINE, "x"), (1, LINE, "x"), (2, None, "x"), (3, "...", "x"), (None, "two three", "x"), (4, "A.B", "x")], "item_id long, text string, items string"
    )
    for block in (1_000_000, 3):
        found = decontaminate.contamination(docs, items, block_words=block).select("row.doc_id", "n_words", "n_hit", "items").collect()
        by = {r[0]: r[1:] for r in found}
        assert len(found) == len(ROWS)
        assert by[1] == (12, 12, ["1"]) == by[None] and by[2] == (0, 0, []) == by[3] and by[6] == (5, 2, ["4"])
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    assert decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(none, items).count() == 0


def test_pii(docs, none):
    found = pii.redacted(docs)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    assert texts[6] == ("[EMAIL] 12", 10) and texts[2] == (None, None) and texts[3] == ("", 0)
    assert pii.personal_data(none).count() == 0


def test_byte_bpe(docs, none):
    ranks = P.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.encoded(docs, ranks, P.PATTERN)
    rows = {r["row"]["doc_id"]: r for r in found.collect()}
    assert rows[2]["n_tokens"] == 0 == rows[3]["n_tokens"] and rows[1]["n_tokens"] > 0
    back = byte_bpe.decoded(found.select("row.doc_id", "ids"), ranks).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {d: t or "" for d, t, *_ in ROWS}
    assert byte_bpe.encoded(none, ranks, P.PATTERN).count() == 0


def test_topk(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, 0.5]), (0, [0.5, 0.5]), (1, [0.5, None]), (2, None), (3, []), (4, [inf, 0.0]), (5, [nan, 0.0]), (None, [1.0, 1.0])]
    rows += [(7, [0.5]), (8, [0.5, 0.5]), (9, [0.5, 0.5]), (10, [-0.001, 0.0]), (11, [0.5, 0.5]), (11, [0.25, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in topk.nearest(vectors, vectors.filter("vec_id = 0"), k=5).orderBy("rank").collect()]
    one = 2 * 128 * 128
    assert found == [(0, 1, 8, one), (0, 2, 9, one), (0, 3, 11, one), (0, 4, 7, 128 * 128), (0, 5, 11, 64 * 128)]
    assert topk.nearest(vectors.limit(0), vectors, k=5).count() == 0
    assert topk.nearest(vectors, vectors.limit(0), k=5).count() == 0
    assert topk.nearest(vectors.filter("vec_id = 0"), vectors.filter("vec_id = 0"), k=5).count() == 0


def test_chat(spark):
    rows = [(1, 2, "assistant", None, "x"), (1, 1, None, "hi", "x"), (1, 1, None, "hi", "x"), (None, None, "user", "<|end|>", "x"), (2, 0, "assistant", LONG, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    found = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.digests(table).collect()}
    assert found == {1: (3, 0), None: (1, 0), 2: (1, len(LONG))}
    pieces = chat.formatted(table).filter("conv_id = 2").collect()
    whole = pieces[0]["text"]
    assert len(pieces) == 1 and [whole[m["start"] : m["end"]] for m in pieces[0]["marked"]] == [LONG]
    assert chat.digests(table.limit(0)).count() == 0


def test_rans(docs, none):
    found = [tuple(r) for r in rans.written(docs, P.path("word_bpe_49k.json")).orderBy("start").collect()]
    assert [r[0] for r in found] == [None, 1, 2, 3, 4, 4, 5, 6]
    starts = [0]
    for r in found:
        starts.append(starts[-1] + r[2])
    assert [r[1] for r in found] == starts[:-1] and found[2][2] == found[3][2] == 1 and found[2][3] == found[3][3]
    assert rans.written(none, P.path("word_bpe_49k.json")).count() == 0


def test_stages_keep_the_columns(spark, docs):
    import corpus_pipeline

    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert pii.redacted(docs.select("doc_id", "text", "n_chars")).columns == ["doc_id", "text", "n_chars"]
    assert docs.filter(F.col("doc_id").isNull()).count() == 1
