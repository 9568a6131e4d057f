"""Flows give the batch result however the input is split, and survive replays."""

from pyspark.sql import functions as F

from parchline.operators.monitor import enforce
from parchline.plans.views import EXTRACTION_CONFIG, line_parts, typed_view
from parchline.sources.tables import read_table, write_batch
from parchline.streaming import flows
from parchline.streaming.monitors import ProgressLog


def run_all(spark, root, max_files=None):
    flows.finish(flows.extraction_flow(spark, root, EXTRACTION_CONFIG, line_parts, max_files))
    flows.finish(flows.instance_flow(spark, root, max_files=max_files))
    flows.finish(flows.chunk_flow(spark, root, max_files=max_files))
    flows.finish(flows.gold_flow(spark, root, "m", max_files=max_files))
    gold = flows.current_gold(spark, root).select("chunk_id", "source_count", F.md5("chunk_text")).collect()
    return sorted(tuple(r) for r in gold)


def test_one_batch_equals_many(spark, folder, tmp_path):
    # The path rules are left out: which copy comes first may decide the method.
    bronze = typed_view(spark, folder).filter(~F.col("source_classification_tag").isin("src1", "src2"))
    write_batch(bronze.coalesce(1), f"{tmp_path}/one/bronze", 0)
    whole = run_all(spark, f"{tmp_path}/one")
    parts = bronze.randomSplit([0.4, 0.3, 0.3], seed=3)
    many = f"{tmp_path}/many"
    for batch, part in enumerate(parts[:2]):
        write_batch(part.coalesce(1), f"{many}/bronze", batch)
    run_all(spark, many, max_files=1)
    write_batch(parts[2].coalesce(1), f"{many}/bronze", 2)
    assert run_all(spark, many, max_files=1) == whole and len(whole) > 50
    assert run_all(spark, many) == whole  # nothing new: nothing changes


def test_replayed_batch_does_not_lose_its_rows(spark, folder, tmp_path):
    """A batch written but not committed runs again; its first attempt must not count as seen."""
    root = str(tmp_path)
    write_batch(typed_view(spark, folder), f"{root}/bronze", 0)
    flows.finish(flows.extraction_flow(spark, root, EXTRACTION_CONFIG, line_parts))
    before = read_table(spark, f"{root}/extracted", flows.EXTRACTED).count()
    (tmp_path / "checkpoints" / "extraction" / "commits" / "0").unlink()
    for crc in (tmp_path / "checkpoints" / "extraction" / "commits").glob(".*.crc"):
        crc.unlink()
    flows.finish(flows.extraction_flow(spark, root, EXTRACTION_CONFIG, line_parts))
    assert read_table(spark, f"{root}/extracted", flows.EXTRACTED).count() == before > 0


def test_files_are_captured_once(spark, tmp_path):
    source, root = tmp_path / "src" / "team", str(tmp_path / "out")
    source.mkdir(parents=True)
    (source / "a.txt").write_text("one one")
    flows.finish(flows.capture_flow(spark, str(tmp_path / "src"), root, accept_text=True))
    (source / "b.txt").write_text("two two")
    flows.finish(flows.capture_flow(spark, str(tmp_path / "src"), root, accept_text=True))
    rows = read_table(spark, f"{root}/bronze", flows.BRONZE).orderBy("file_name").collect()
    assert [(r["file_name"], r["file_type"], r["source_classification_tag"], r["batch_id"]) for r in rows] == [
        ("a.txt", "text", "team", 0),
        ("b.txt", "text", "team", 1),
    ]


def test_expectation_modes(spark):
    import pytest

    frame = spark.createDataFrame([(1,), (None,), (5,)], "n int")
    rule = {"small": F.col("n") < 3}
    assert [r["small"] for r in enforce(frame, rule, "warn").collect()] == [True, False, False]
    assert enforce(frame, rule, "drop").count() == 1
    with pytest.raises(Exception, match="small"):
        enforce(frame, rule, "fail").collect()
    assert enforce(frame.filter("n = 1"), rule, "fail").count() == 1


def test_replayed_extraction_does_not_double_chunks(spark, folder, tmp_path):
    root = str(tmp_path)
    write_batch(typed_view(spark, folder), f"{root}/bronze", 0)
    run_all(spark, root)
    before = read_table(spark, f"{root}/chunks", flows.CHUNKS).count()
    commits = tmp_path / "checkpoints" / "extraction" / "commits"
    for file in [commits / "0", *commits.glob(".*.crc")]:
        file.unlink()
    run_all(spark, root)
    chunks = read_table(spark, f"{root}/chunks", flows.CHUNKS)
    assert chunks.count() == chunks.select("chunk_id").distinct().count() == before > 0


def test_all_citations_stay_beside_gold(spark, tmp_path):
    root = str(tmp_path)
    row = "'h' AS content_hash, concat('/p/', id) AS source_path, concat('f', id) AS file_name, current_timestamp() AS ingestion_timestamp"
    more = "'text' AS file_type, 'g' AS resolved_acl_group, 1 AS restrictiveness, true AS is_active, cast(null AS timestamp) AS deactivated_at"
    instances = spark.sql(f"SELECT {row}, {more} FROM range(2500)")
    write_batch(instances, f"{root}/instances", 0)
    chunk = spark.sql("SELECT 'c' AS chunk_id, 'h' AS content_hash, 0 AS chunk_index, 'text' AS chunk_text, '' AS section_heading, 'm' AS chunking_method_used, 'm' AS extraction_method_used, 1 AS token_count, true AS is_active")
    write_batch(chunk, f"{root}/chunks", 0)
    flows.finish(flows.gold_flow(spark, root, "m"))
    parts = flows.current_references(spark, root).collect()
    assert {r["source_path"] for p in parts for r in p["source_references"]} == {f"/p/{i}" for i in range(2500)}
    assert flows.current_gold(spark, root).collect()[0]["source_count"] == 2500


def test_progress_of_every_batch_is_kept(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"{i:03}.txt").write_text(f"line {i}")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path))
    with ProgressLog(spark, str(tmp_path / "log")) as log:
        running = (
            lines.writeStream.queryName("many")
            .format("noop")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        flows.finish(running)
        log.wait(running)
    rows = log.table().filter("input_rows > 0").collect()
    assert sorted(r["batch_id"] for r in rows) == list(range(150)) and {r["flow"] for r in rows} == {"many"}


def test_replayed_batches_are_handed_on_once(spark, folder, tmp_path):
    """Each flow's batch written again under new file names is not taken again by the flows after it."""
    import json

    from parchline.plans.streams import replay

    root = str(tmp_path)
    bronze = typed_view(spark, folder)
    write_batch(bronze, f"{root}/bronze", 0)
    first = run_all(spark, root)
    tables = {"bronze": flows.BRONZE, "instances": flows.INSTANCES, "extracted": flows.EXTRACTED, "chunks": flows.CHUNKS}
    counts = {name: read_table(spark, f"{root}/{name}", schema).count() for name, schema in tables.items()}
    for name in ("bronze", "extracted", "chunks"):
        replay(spark, f"{root}/{name}", 0, tables[name])
    assert run_all(spark, root) == first
    assert {name: read_table(spark, f"{root}/{name}", schema).count() for name, schema in tables.items()} == counts
    record = json.loads((tmp_path / "bronze" / "_commits" / "batch_0.json").read_text())
    assert record["rows"] == counts["bronze"] == bronze.count() and record["files"]
    assert json.loads((tmp_path / "extracted" / "_commits" / "batch_0.json").read_text())["inputs"] == [0]
