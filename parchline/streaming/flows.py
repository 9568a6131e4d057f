"""The append flows from files to gold.

Every flow has its own checkpoint and writes each micro-batch to a folder of its own, so a replayed
batch replaces itself, and commits it with a record named after the batch. A flow follows the records
of the tables it reads, not their folders: a batch is handed on exactly once, whether or not its
writer replays it under new file names. Deduplication looks up the written tables; no flow keeps
state that grows without bound. Tables and checkpoints lie under one shared root.
"""

from __future__ import annotations

from typing import Any, Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.vector import hash_embedding
from ..operators.capture import enrich, valid_only
from ..operators.chunks import chunk
from ..operators.gold import gold_rows, reference_parts
from ..operators.lifecycle import instances, latest_instance, new_content, one_per_key, reconcile, winners, with_bytes
from ..operators.rules import CHUNKING_RULES, extraction_decision
from ..operators.sections import SECTIONS_TYPE, extract
from ..sources.files import stream_files
from ..sources.tables import follow_commits, read_committed, read_table, stored, write_batch

# The table schemas.
BRONZE = (
    "content binary, source_path string, file_name string, file_size bigint, file_modification_time timestamp, "
    "ingestion_timestamp timestamp, content_hash string, file_type string, source_classification_tag string, "
    "processing_status string"
)
EXTRACTED = (
    "content_hash string, file_type string, extraction_method_used string, extraction_status string, "
    f"full_text string, sections {SECTIONS_TYPE}, error_message string, extracted_at timestamp"
)
INSTANCES = (
    "source_path string, file_name string, content_hash string, ingestion_timestamp timestamp, file_type string, "
    "resolved_acl_group string, restrictiveness int, is_active boolean, deactivated_at timestamp"
)
CHUNKS = (
    "chunk_id string, content_hash string, chunk_index int, chunk_text string, section_heading string, "
    "chunking_method_used string, extraction_method_used string, token_count int, is_active boolean"
)
REFERENCES = (
    "content_hash string, part_no int, n_parts int, source_count bigint, "
    "source_references array<struct<source_path:string,file_name:string>>"
)
GOLD = (
    "chunk_id string, chunk_text string, embedding_vector array<float>, embedding_model string, "
    "embedded_at timestamp, source_references array<struct<source_path:string,file_name:string>>, "
    "source_count bigint, content_hash string, section_heading string, resolved_acl_group string, "
    "acl_conflict_detected boolean, chunking_method_used string, extraction_method_used string"
)
TOUCHED = "content_hash string"


def start(stream: DataFrame, root: str, flow: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is available now, then stop; the checkpoint remembers how far it came."""
    return (
        stream.writeStream.queryName(flow)
        .foreachBatch(handle)
        .option("checkpointLocation", f"{root}/checkpoints/{flow}")
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery, timeout: int = 1800) -> StreamingQuery:
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"flow {query.name} did not finish in {timeout} s")
    return query


def capture_flow(spark: SparkSession, source: str, root: str, max_files: int | None = None, accept_text: bool = False):
    files = stream_files(spark, source, max_files).filter(F.col("content").isNotNull())

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(enrich(batch, accept_text=accept_text), f"{root}/bronze", batch_id)

    return start(files, root, "capture", handle)


def extraction_flow(
    spark: SparkSession,
    root: str,
    config: dict[str, Any],
    parts_reader: Callable[[Column, Column], Column],
    max_files: int | None = None,
):
    """``parts_reader`` opens the files, see ``operators.sections.extract``."""

    def handle(commits: DataFrame, batch_id: int) -> None:
        batch, inputs = read_committed(spark, f"{root}/bronze", BRONZE, commits)
        done = read_table(spark, f"{root}/extracted", EXTRACTED, before=batch_id)
        fresh = extract(new_content(batch, settled(batch, done, config), retry_failed=False), parts_reader, config)
        write_batch(fresh.withColumn("extracted_at", F.current_timestamp()), f"{root}/extracted", batch_id, inputs)

    return start(follow_commits(spark, f"{root}/bronze", max_files), root, "extraction", handle)


def settled(batch: DataFrame, done: DataFrame, config: dict[str, Any]) -> DataFrame:
    """Content that needs no attempt now: extracted, or failed with the method the rules give its copy now.

    A failed content is tried again only when the rules decide another method for the copy that would be
    extracted (another path, or changed rules); the same attempt would fail the same way and add a row.
    """
    ok = done.filter(F.col("extraction_status").isin("success", "empty")).select("content_hash")
    chosen = with_bytes(valid_only(batch).select("content_hash", "source_path", "file_type"), winners(valid_only(batch)))
    method = extraction_decision(F.col("source_path"), F.col("file_type"), config)["method"]
    now = chosen.select("content_hash", method.alias("method"))
    failed = done.filter(~F.col("extraction_status").isin("success", "empty")).select("content_hash", "extraction_method_used")
    same = failed.join(now, (failed.content_hash == now.content_hash) & failed.extraction_method_used.eqNullSafe(now.method), "left_semi")
    return ok.unionByName(same.select("content_hash"))


def instance_flow(
    spark: SparkSession, root: str, resolve: Callable[[DataFrame], DataFrame] | None = None, max_files: int | None = None
):
    """``resolve`` may fill ``resolved_acl_group`` and ``restrictiveness`` from the source tag."""

    def handle(commits: DataFrame, batch_id: int) -> None:
        batch, inputs = read_committed(spark, f"{root}/bronze", BRONZE, commits)
        rows = resolve(batch) if resolve else instances(batch).withColumn("restrictiveness", F.lit(None).cast("int"))
        write_batch(rows.select(*_names(INSTANCES)), f"{root}/instances", batch_id, inputs)

    return start(follow_commits(spark, f"{root}/bronze", max_files), root, "instances", handle)


def chunk_flow(spark: SparkSession, root: str, config: dict[str, Any] = CHUNKING_RULES, max_files: int | None = None):
    def handle(commits: DataFrame, batch_id: int) -> None:
        batch, inputs = read_committed(spark, f"{root}/extracted", EXTRACTED, commits)
        # A content extracted again after a failed attempt may give chunks that are known by then. Only such contents
        # can repeat a chunk, whose id is made of content and place; they are found by hash alone and stored, so that
        # the planner knows their size and the texts of all others need no shuffle.
        known = read_table(spark, f"{root}/chunks", CHUNKS, before=batch_id).select("chunk_id", "content_hash")
        hashes = batch.select("content_hash")
        twice = hashes.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("content_hash")
        before = known.select("content_hash").join(hashes.distinct(), "content_hash", "left_semi")
        again = stored(twice.union(before).distinct(), "again")
        fresh = chunk(batch.join(again, "content_hash", "left_anti"), config).select(*_names(CHUNKS))
        repeated = chunk(batch.join(again, "content_hash", "left_semi"), config).select(*_names(CHUNKS))
        repeated = repeated.dropDuplicates(["chunk_id"]).join(known.select("chunk_id"), "chunk_id", "left_anti")
        write_batch(fresh.unionByName(repeated.select(*_names(CHUNKS))), f"{root}/chunks", batch_id, inputs)

    return start(follow_commits(spark, f"{root}/extracted", max_files), root, "chunks", handle)


def gold_flow(spark: SparkSession, root: str, model: str, embed=hash_embedding, max_files: int | None = None):
    """Recompute gold for all content touched by a new chunk *or* a new instance row.

    So a chunk that comes before its instance is completed later, and content that lost its last
    active instance disappears: the touched list names it, and no row follows. A batch writes the
    touched hashes and their rows; ``current_gold`` reads the newest batch of each content.
    """
    from_chunks = follow_commits(spark, f"{root}/chunks", max_files).withColumn("table", F.lit("chunks"))
    from_instances = follow_commits(spark, f"{root}/instances", max_files).withColumn("table", F.lit("instances"))

    def handle(commits: DataFrame, batch_id: int) -> None:
        chunk_rows, _ = read_committed(spark, f"{root}/chunks", CHUNKS, commits.filter("table = 'chunks'"))
        instance_rows, _ = read_committed(spark, f"{root}/instances", INSTANCES, commits.filter("table = 'instances'"))
        batch = chunk_rows.select("content_hash", F.lit(None).cast("string").alias("source_path")).unionByName(
            instance_rows.select("content_hash", "source_path")
        )
        history = read_table(spark, f"{root}/instances", INSTANCES).drop("batch_id")
        # A path that changed its content also touches the content it had before.
        paths = batch.filter(F.col("source_path").isNotNull()).select("source_path").distinct()
        earlier = history.join(paths, "source_path", "left_semi").select("content_hash")
        touched = batch.select("content_hash").unionByName(earlier).distinct()
        write_batch(touched, f"{root}/gold_touched", batch_id)

        touched = spark.read.parquet(f"{root}/gold_touched/batch_id={batch_id}")
        of_touched = history.join(
            history.join(touched, "content_hash", "left_semi").select("source_path").distinct(), "source_path", "left_semi"
        )
        current = latest_instance(of_touched).join(touched, "content_hash", "left_semi")
        # ``current`` holds touched contents alone, so the join with it leaves their chunks.
        chunks = one_per_key(read_table(spark, f"{root}/chunks", CHUNKS).drop("batch_id"), "chunk_id")
        rows = gold_rows(chunks, current, model, embed)
        write_batch(rows, f"{root}/gold", batch_id)
        write_batch(reference_parts(current).select(*_names(REFERENCES)), f"{root}/gold_references", batch_id)

    return start(from_chunks.unionByName(from_instances), root, "gold", handle)


def current_references(spark: SparkSession, root: str) -> DataFrame:
    """Every citation of the contents in gold as of now, in parts."""
    newest = read_table(spark, f"{root}/gold_touched", TOUCHED).groupBy("content_hash").agg(F.max("batch_id").alias("batch_id"))
    rows = read_table(spark, f"{root}/gold_references", REFERENCES)
    return rows.join(newest, ["content_hash", "batch_id"], "left_semi").drop("batch_id").select(*_names(REFERENCES))


def current_gold(spark: SparkSession, root: str) -> DataFrame:
    """Gold as of now: for each content, the rows of the batch that touched it last."""
    newest = read_table(spark, f"{root}/gold_touched", TOUCHED).groupBy("content_hash").agg(F.max("batch_id").alias("batch_id"))
    rows = read_table(spark, f"{root}/gold", GOLD)
    return rows.join(newest, ["content_hash", "batch_id"], "left_semi").drop("batch_id").select(*_names(GOLD))


def reconcile_instances(spark: SparkSession, root: str, listing: DataFrame, now, batch_id: int) -> None:
    """Append a deactivated version of every active instance whose file is gone.

    ``batch_id`` must lie outside the instance flow's range (negative numbers are free).
    """
    current = latest_instance(read_table(spark, f"{root}/instances", INSTANCES).drop("batch_id"))
    gone = reconcile(current.filter("is_active"), listing, now).filter(~F.col("is_active"))
    write_batch(gone.withColumn("ingestion_timestamp", now).select(*_names(INSTANCES)), f"{root}/instances", batch_id)


def _names(schema: str) -> list[str]:
    return StructType.fromDDL(schema).fieldNames()
