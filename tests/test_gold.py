"""Access groups, citations in parts, dedup and reconciliation."""

from pyspark.sql import functions as F

from parchline.operators.gold import acl_by_content, acl_most_restrictive, gold_rows, reference_parts
from parchline.operators.lifecycle import latest_instance, not_seen, one_per_content, reconcile, snapshot_changes

ROWS = "content_hash string, source_path string, resolved_acl_group string, restrictiveness int, is_active boolean"


def current(spark, rows):
    frame = spark.createDataFrame(rows, ROWS)
    return frame.withColumn("file_name", F.element_at(F.split("source_path", "/"), -1))


def test_acl(spark):
    rows = [
        ("none", "/a", None, None, True),
        ("one", "/b", "staff", 1, True),
        ("one", "/c", "staff", 1, True),
        ("two", "/d", "staff", 1, True),
        ("two", "/e", "board", 9, True),
        ("two", "/f", None, None, True),
        ("gone", "/g", "staff", 1, False),
    ]
    frame = current(spark, rows)
    by = {r["content_hash"]: tuple(r)[1:] for r in acl_by_content(frame).collect()}
    assert by == {"none": (None, False), "one": ("staff", False), "two": (None, True)}
    strict = {r["content_hash"]: tuple(r)[1:] for r in acl_most_restrictive(frame).collect()}
    assert strict == {"none": (None, False), "one": ("staff", False), "two": ("board", True)}


def test_many_sources_are_kept_whole(spark):
    """One content with a third of all rows: its citations come in several parts, none missing."""
    rows = [("hot", f"/h/{i}", "g", 1, True) for i in range(500)]
    rows += [(f"c{i}", f"/c/{i}", "g", 1, True) for i in range(1000)]
    found = reference_parts(current(spark, rows), per_part=50).collect()
    hot = [r for r in found if r["content_hash"] == "hot"]
    assert len(hot) == 10 and {r["source_count"] for r in hot} == {500}
    assert sorted(s["source_path"] for r in hot for s in r["source_references"]) == sorted(f"/h/{i}" for i in range(500))
    assert all(len(r["source_references"]) == 1 for r in found if r["content_hash"] != "hot")


def test_gold_has_one_row_per_chunk(spark):
    chunks = spark.createDataFrame(
        [("k1", "a", "text one"), ("k2", "a", "text two"), ("k3", "lost", "no instance")],
        "chunk_id string, content_hash string, chunk_text string",
    ).select(
        "*",
        F.lit(None).cast("string").alias("section_heading"),
        F.lit("m").alias("chunking_method_used"),
        F.lit("e").alias("extraction_method_used"),
        F.lit(True).alias("is_active"),
    )
    rows = [("a", "/1", "g", 1, True), ("a", "/2", "g", 1, True), ("a", "/2", "g", 1, True), ("lost", "/3", "g", 1, False)]
    gold = {r["chunk_id"]: r for r in gold_rows(chunks, current(spark, rows), "model").collect()}
    assert set(gold) == {"k1", "k2"}
    assert [s["source_path"] for s in gold["k1"]["source_references"]] == ["/1", "/2"]
    assert gold["k1"]["source_count"] == 2 and len(gold["k1"]["embedding_vector"]) == 64


def test_gold_carries_every_source(spark):
    chunks = spark.createDataFrame([("k1", "hot", "text"), ("k2", "one", "text")], "chunk_id string, content_hash string, chunk_text string").select(
        "*",
        F.lit(None).cast("string").alias("section_heading"),
        F.lit("m").alias("chunking_method_used"),
        F.lit("e").alias("extraction_method_used"),
        F.lit(True).alias("is_active"),
    )
    rows = [("hot", f"/h/{i}", "g", 1, True) for i in range(2500)] + [("one", "/1", "g", 1, True)]
    gold = {r["chunk_id"]: r for r in gold_rows(chunks, current(spark, rows), "model").collect()}
    assert [s["source_path"] for s in gold["k1"]["source_references"]] == sorted(f"/h/{i}" for i in range(2500))
    assert gold["k1"]["source_count"] == 2500 and len(gold["k2"]["source_references"]) == 1


def test_dedup_and_lookup(spark):
    bronze = spark.createDataFrame([("h", "/b"), ("h", "/a"), ("k", "/c")], "content_hash string, source_path string")
    assert sorted(tuple(r) for r in one_per_content(bronze).collect()) == [("h", "/a"), ("k", "/c")]
    seen = spark.createDataFrame([("k",), ("z",)], "content_hash string")
    assert [r["content_hash"] for r in not_seen(bronze, seen).select("content_hash").distinct().collect()] == ["h"]


def test_latest_and_reconcile(spark):
    history = spark.createDataFrame(
        [("/a", "old", 1, True), ("/a", "new", 2, True), ("/b", "x", 1, True)],
        "source_path string, content_hash string, ingestion_timestamp int, is_active boolean",
    )
    latest = latest_instance(history)
    assert sorted((r["source_path"], r["content_hash"]) for r in latest.collect()) == [("/a", "new"), ("/b", "x")]
    now = F.lit("2024-01-01").cast("timestamp")
    live = spark.createDataFrame([("/a",)], "path string")
    found = reconcile(latest.withColumn("deactivated_at", F.lit(None).cast("timestamp")), live, now).collect()
    assert {r["source_path"]: r["is_active"] for r in found} == {"/a": True, "/b": False}


def test_snapshot_changes(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    found = {r["k"]: r["change"] for r in snapshot_changes(before, after, "k", ["v"]).collect()}
    assert found == {1: "delete", 2: "update", 4: "insert"}


def test_mirror_follows_deletions_to_the_last_row(spark, tmp_path):
    from parchline.sources.tables import read_mirror, sync_mirror

    folder = str(tmp_path / "mirror")
    before = spark.createDataFrame([(i, f"v{i}") for i in range(30)], "k int, v string")
    after = spark.createDataFrame([(3, "new"), (40, "v40")], "k int, v string")
    sync_mirror(folder, before, before, "k", buckets=4)
    sync_mirror(folder, after, snapshot_changes(before, after, "k", ["v"]), "k", buckets=4)
    assert sorted(tuple(r) for r in read_mirror(spark, folder, "k").collect()) == [(3, "new"), (40, "v40")]
    sync_mirror(folder, after.limit(0), after, "k", buckets=4)
    assert read_mirror(spark, folder, "k").count() == 0


def test_golden_versions_by_blocks(spark):
    from parchline.operators.evaluate import golden_as_of, golden_versions

    rows = [("q", t, t % 3 == 0) for t in range(0, 20000, 500)] + [("r", 7, True)]
    frame = spark.createDataFrame(rows, "question string, at bigint, ok boolean")
    versions = golden_versions(frame, "question", F.col("ok"), "at")
    found = sorted((r["question"], r["version"], r["valid_from"], r["valid_to"]) for r in versions.collect())
    times = [t for q, t, ok in rows if q == "q" and ok]
    expected = [("q", i + 1, t, n) for i, (t, n) in enumerate(zip(times, [*times[1:], None]))]
    assert found == [*expected, ("r", 1, 7, None)]
    assert golden_as_of(versions, F.lit(times[2])).filter("question = 'q'").first()["version"] == 3


def test_physical_delete_rewrites_only_touched_buckets(spark, tmp_path):
    from parchline.sources.tables import current_version, delete_keys, read_versioned, write_versioned

    schema = "chunk_id string, content_hash string, chunk_text string"
    rows = spark.createDataFrame([(f"c{i}", f"h{i % 50}", "t") for i in range(500)], schema)
    folder = str(tmp_path / "served")
    write_versioned(rows, folder, "content_hash", depth=4)
    opened = read_versioned(spark, folder, schema)  # a reader open during the swap
    _, before = current_version(spark, folder)
    keys = spark.createDataFrame([("h3",), ("h7",), ("h3",), ("absent",)], "content_hash string")
    assert delete_keys(spark, folder, keys, "content_hash", schema) == 1
    after = read_versioned(spark, folder, schema)
    assert opened.count() == 500 and after.count() == 480
    assert {r["content_hash"] for r in after.collect()} == {f"h{i}" for i in range(50)} - {"h3", "h7"}
    number, mapping = current_version(spark, folder)
    moved = {b for b in before if mapping.get(b) != before[b]}
    assert number == 1 and 1 <= len(moved) <= 2  # only the buckets of h3 and h7 were written again
    assert delete_keys(spark, folder, keys, "content_hash", schema) == 1  # nothing left to delete: no new version


def test_versioned_sync_splits_buckets_that_grow(spark, tmp_path):
    from parchline.operators.lifecycle import snapshot_changes
    from parchline.sources.tables import current_version, read_versioned, sync_versioned, write_versioned

    schema = "k long, v string"
    before = spark.createDataFrame([(i, f"v{i}") for i in range(40)], schema)
    after = spark.createDataFrame([(i, "new" if i % 7 == 0 else f"v{i}") for i in range(3, 400)], schema)
    folder = str(tmp_path / "mirror")
    write_versioned(before, folder, "k", depth=1, max_rows=50)
    assert current_version(spark, folder)[1].keys() == {"1-0", "1-1"}
    opened = read_versioned(spark, folder, schema)
    sync_versioned(folder, after, snapshot_changes(before, after, "k", ["v"]), "k", max_rows=50)
    number, mapping = current_version(spark, folder)
    assert number == 1 and len(mapping) > 4 and all(int(b.split("-")[0]) > 1 for b in mapping)
    assert sorted(tuple(r) for r in read_versioned(spark, folder, schema).collect()) == sorted(tuple(r) for r in after.collect())
    assert opened.count() == 40  # the reader opened before the swap keeps the old version
    sync_versioned(folder, after.limit(0), after, "k", max_rows=50)
    assert read_versioned(spark, folder, schema).count() == 0
