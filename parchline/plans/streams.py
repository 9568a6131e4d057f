"""Continuous flows run to the end of their input, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.gold import resolve_acl
from ..operators.lifecycle import instances
from ..session import fresh_dir
from ..sources.tables import exists, table, write_batch
from ..streaming import flows, monitors
from .gold import MODEL
from .lifecycle import labelled, now
from .registry import query
from .silver import DISPATCHED, chunk_digest
from .views import (
    ACL_MAP,
    EXTRACTION_CONFIG,
    FIXED_CHUNKS,
    INSTANCES,
    LIVE,
    UNIQUE,
    acl_map,
    chunks_view,
    line_parts,
    live_listing,
    sql_approx_tokens,
    sql_time,
    time_text,
    typed_view,
    with_ctes,
)

# The labelled documents come first, so a copy among them wins over an earlier path that comes
# later. If its method is unknown the extraction failed, and a later copy is tried again.
_STREAM_UNIQUE = """
uniq AS (
  SELECT t.* FROM typed t
  JOIN (SELECT content_hash, CASE WHEN first IS NULL OR (later IS NOT NULL AND file_type = 'docx' AND contains(first, '/src2/'))
                             THEN later ELSE first END AS source_path
        FROM (SELECT content_hash, file_type, min(source_path) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS first,
                     min(source_path) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS later
              FROM typed GROUP BY content_hash, file_type)) w USING (content_hash, source_path))
"""


_STREAM_CHUNKS = with_ctes(
    DISPATCHED.replace(UNIQUE.strip(), _STREAM_UNIQUE.strip()),
    select=f"""
    SELECT sha256(content_hash || '_' || chunk_index) AS chunk_id, content_hash, chunk_index, md5(piece) AS text_md5,
           heading AS section_heading, method AS chunking_method_used, extraction_method_used,
           {sql_approx_tokens("piece")} AS token_count
    FROM dispatched JOIN extracted USING (content_hash)""",
)


@query("stream_bronze_to_chunks", _STREAM_CHUNKS)
def stream_bronze_to_chunks(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_dir(spark, "flow")
    bronze = typed_view(spark, folder)
    for batch, present in enumerate((True, False)):
        write_batch(labelled(spark, folder, bronze, present).select(*bronze.columns), f"{root}/bronze", batch)
        flows.finish(flows.extraction_flow(spark, root, EXTRACTION_CONFIG, line_parts))
        flows.finish(flows.chunk_flow(spark, root))
    return chunk_digest(flows.read_table(spark, f"{root}/chunks", flows.CHUNKS))


def replay(spark: SparkSession, folder: str, batch_id: int, schema: str) -> None:
    """Write a batch again, as its flow does when it is replayed: same rows, new file names."""
    if not exists(spark, f"{folder}/batch_id={batch_id}"):
        return
    write_batch(spark.read.schema(schema).parquet(f"{folder}/batch_id={batch_id}"), folder, batch_id)


@query("stream_replay_once", _STREAM_CHUNKS)
def stream_replay_once(spark: SparkSession, folder: str) -> DataFrame:
    """Capture, extraction and chunking each write their batch again after it was handed on; every flow
    runs again: no batch is taken twice, so instances are not doubled and chunks equal the batch result."""
    root = fresh_dir(spark, "replay")
    bronze = typed_view(spark, folder)
    for batch, present in enumerate((True, False)):
        write_batch(labelled(spark, folder, bronze, present).select(*bronze.columns), f"{root}/bronze", batch)
        for _ in range(2):
            flows.finish(flows.extraction_flow(spark, root, EXTRACTION_CONFIG, line_parts))
            flows.finish(flows.instance_flow(spark, root))
            flows.finish(flows.chunk_flow(spark, root))
            flows.finish(flows.gold_flow(spark, root, MODEL))
            for name, schema in (("bronze", flows.BRONZE), ("extracted", flows.EXTRACTED), ("chunks", flows.CHUNKS)):
                replay(spark, f"{root}/{name}", batch, schema)
    return chunk_digest(flows.read_table(spark, f"{root}/chunks", flows.CHUNKS))


@query(
    "stream_gold_late_instance",
    with_ctes(
        FIXED_CHUNKS,
        ACL_MAP,
        INSTANCES,
        LIVE,
        """
        served AS (
          SELECT content_hash, arg_max(resolved_acl_group, restrictiveness) AS resolved_acl_group, count(*) AS source_count
          FROM instances JOIN live ON path = source_path GROUP BY content_hash)""",
        select="SELECT chunk_id, content_hash, source_count, resolved_acl_group FROM chunks JOIN served USING (content_hash)",
    ),
)
def stream_gold_late_instance(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks first, instances later in two batches, deletions last: gold follows each time."""
    root = fresh_dir(spark, "late")
    mapping = acl_map(spark, folder)

    def resolve(batch: DataFrame) -> DataFrame:
        tag = F.element_at(F.split("source_path", "/"), -2)
        return resolve_acl(instances(batch).withColumn("source_classification_tag", tag), mapping)

    write_batch(chunks_view(spark, folder), f"{root}/chunks", 0)
    write_batch(spark.createDataFrame([], flows.INSTANCES), f"{root}/instances", -2)
    flows.finish(flows.gold_flow(spark, root, MODEL))
    bronze = typed_view(spark, folder)
    for batch, present in enumerate((True, False)):
        write_batch(labelled(spark, folder, bronze, present).select(*bronze.columns), f"{root}/bronze", batch)
        flows.finish(flows.instance_flow(spark, root, resolve))
        flows.finish(flows.gold_flow(spark, root, MODEL))
    flows.reconcile_instances(spark, root, live_listing(spark, folder), now(), batch_id=-1)
    flows.finish(flows.gold_flow(spark, root, MODEL))
    gold = flows.current_gold(spark, root)
    return gold.select("chunk_id", "content_hash", "source_count", "resolved_acl_group")


# --- windows over events --------------------------------------------------------------------------


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_table(spark: SparkSession, stream: DataFrame, name: str):
    """Append the stream's finished rows to a table; returns the query and the rows."""
    root = fresh_dir(spark, name)
    running = (
        stream.writeStream.queryName(name)
        .format("parquet")
        .option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    flows.finish(running)
    return running, spark.read.schema(stream.schema).parquet(f"{root}/rows")


_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(
    "stream_hourly_counts",
    f"""
    SELECT {sql_time("date_trunc('hour', ts)")} AS window_start, event_type, count(*) AS events FROM events
    GROUP BY date_trunc('hour', ts), event_type HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED}
    """,
)
def stream_hourly_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = monitors.hourly_counts(event_stream(spark, folder), "ts", ["event_type"])
    return run_to_table(spark, counts, "hourly")[1].withColumn("window_start", time_text("window_start"))


@query(
    "stream_sessions",
    f"""
    WITH steps AS (
      SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
      FROM events),
    runs AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM steps)
    SELECT user_id, {sql_time("min(ts)")} AS session_start, {sql_time("max(ts) + INTERVAL 30 MINUTE")} AS session_end, count(*) AS events
    FROM runs GROUP BY user_id, run HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}
    """,
)
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    found = monitors.sessions(event_stream(spark, folder), "ts", "user_id")
    rows = run_to_table(spark, found, "sessions")[1]
    return rows.withColumns({c: time_text(c) for c in ("session_start", "session_end")})


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First sighting of each user and event type within the watermark delay."""
    unique = monitors.deduplicated(event_stream(spark, folder), "ts", ["user_id", "event_type"], late="60 days")
    return run_to_table(spark, unique, "dedup")[1].select("user_id", "event_type")


@query(
    "stream_safety_breach",
    f"""
    SELECT {sql_time("date_trunc('hour', ts)")} AS window_start, count(*) AS breaches FROM events
    WHERE event_type = 'error' AND value > 20 GROUP BY date_trunc('hour', ts)
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR
           <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events WHERE event_type = 'error' AND value > 20)
    """,
)
def stream_safety_breach(spark: SparkSession, folder: str) -> DataFrame:
    # The filter runs before the watermark is taken, so breaches alone move it forward.
    bad = (F.col("event_type") == "error") & (F.col("value") > 20)
    breaches = monitors.safety_breaches(event_stream(spark, folder), "ts", bad)
    return run_to_table(spark, breaches, "breaches")[1].withColumn("window_start", time_text("window_start"))


@query("stream_progress_metrics", "SELECT 'progress' AS flow, count(*) AS input_rows FROM events")
def stream_progress_metrics(spark: SparkSession, folder: str) -> DataFrame:
    counts = monitors.hourly_counts(event_stream(spark, folder), "ts", ["event_type"])
    with monitors.ProgressLog(spark, fresh_dir(spark, "progress-log")) as log:
        running, _ = run_to_table(spark, counts, "progress")
        log.wait(running)
    return log.table().groupBy("flow").agg(F.sum("input_rows").alias("input_rows"))


@query(
    "flow_backlog",
    """
    SELECT 'extraction' AS flow, 'bronze' AS "table", 2 AS outstanding_batches,
           (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS outstanding_rows""",
)
def flow_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """One batch taken by extraction, then two more committed: those two are its backlog."""
    root = fresh_dir(spark, "backlog")
    bronze = typed_view(spark, folder)
    write_batch(labelled(spark, folder, bronze, True).select(*bronze.columns), f"{root}/bronze", 0)
    flows.finish(flows.extraction_flow(spark, root, EXTRACTION_CONFIG, line_parts))
    later = labelled(spark, folder, bronze, False).select(*bronze.columns)
    half = F.crc32("source_path") % 2
    for batch in (1, 2):
        write_batch(later.filter(half == batch - 1), f"{root}/bronze", batch)
    found = monitors.backlog(spark, root, "extraction", "bronze")
    return found.select("flow", "table", "outstanding_batches", "outstanding_rows")
