"""Batches made from their own files, and which rows of a batch are shuffled."""

import glob
import os

from pyspark.sql import functions as F

from parchline.operators.lifecycle import new_content, one_per_key
from parchline.session import fresh_dir
from parchline.sources.tables import read_table, write_batch


def test_a_batch_is_written_again_from_its_own_rows(spark):
    folder = fresh_dir(spark, "batches")
    write_batch(spark.range(1000).select("id"), folder, 0)
    before = set(glob.glob(f"{folder}/batch_id=0/*.parquet"))
    write_batch(spark.read.schema("id long").parquet(f"{folder}/batch_id=0"), folder, 0)
    after = set(glob.glob(f"{folder}/batch_id=0/*.parquet"))
    assert after and not before & after and all(".zstd." in os.path.basename(f) for f in after)
    found = read_table(spark, folder, "id long")
    assert found.count() == 1000 and found.agg(F.sum("id")).first()[0] == 499_500
    assert not os.listdir(f"{folder}/_staged") and len(glob.glob(f"{folder}/_commits/*.json")) == 1


def test_new_content_with_few_and_with_many_copies(spark):
    schema = "content binary, source_path string, content_hash string, processing_status string"
    few = [(b"x", f"p{i}", f"h{i}", "valid") for i in range(20)] + [(b"x", "q1", "h1", "valid"), (b"x", None, "h7", "valid"), (b"x", "q8", None, "valid")]
    many = [(b"x", f"p{i:02}", "h", "valid") for i in range(20)] + [(b"y", "z", "other", "valid"), (b"x", "bad", "new", "corrupt_pdf")]
    done = spark.createDataFrame([("h3", "success"), ("h4", "no_extraction_rule_matched")], "content_hash string, extraction_status string")
    found = {r["source_path"] for r in new_content(spark.createDataFrame(few, schema), done).collect()}
    assert found == {f"p{i}" for i in range(20) if i != 3}
    assert {r["source_path"] for r in new_content(spark.createDataFrame(many, schema), done).collect()} == {"p00", "z"}


def test_only_rows_of_repeated_keys_are_shuffled(spark):
    rows = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") % 990).alias("key"), F.lit("text").alias("text"))
    kept = one_per_key(rows, "key")
    assert kept.count() == kept.select("key").distinct().count() == 990
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
