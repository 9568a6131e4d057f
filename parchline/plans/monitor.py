"""Monitoring reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import monitor
from ..sources.tables import stored, table
from .registry import query
from .silver import DISPATCHED
from .views import (
    BRONZE,
    EXTRACTED,
    FILES,
    bronze_view,
    dispatched_view,
    extracted_view,
    sql_approx_tokens,
    sql_time,
    time_text,
    with_ctes,
)


@query(
    "table_metrics",
    with_ctes(
        FILES,
        BRONZE,
        select=f"""
        SELECT count(*) AS total_files, count(DISTINCT file_type) AS unique_file_types,
               CAST(sum(file_size) AS BIGINT) AS total_size_bytes, {sql_time("max(ingestion_timestamp)")} AS latest_ingestion,
               {sql_time("min(ingestion_timestamp)")} AS first_ingestion,
               count(*) FILTER (processing_status = 'valid') AS valid_files,
               count(*) FILTER (processing_status <> 'valid') AS invalid_files FROM bronze""",
    ),
)
def table_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = monitor.table_metrics(bronze_view(spark, folder))
    return metrics.withColumns({c: time_text(c) for c in ("latest_ingestion", "first_ingestion")})


@query(
    "file_type_distribution",
    with_ctes(
        FILES,
        BRONZE,
        select="""
        SELECT file_type, processing_status, count(*) AS file_count, CAST(sum(file_size) AS BIGINT) AS total_size_bytes,
               round(avg(file_size), 6) AS avg_size_bytes FROM bronze GROUP BY ALL ORDER BY file_count DESC""",
    ),
)
def file_type_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.file_type_distribution(bronze_view(spark, folder)).withColumn("avg_size_bytes", F.round("avg_size_bytes", 6))


def captured_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as captured files: errors are invalid ones."""
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ingestion_timestamp"),
        F.round(F.col("value") * 100).cast("bigint").alias("file_size"),
        F.when(F.col("event_type") == "error", "corrupt").otherwise("valid").alias("processing_status"),
    )


@query(
    "ingestion_timeline",
    f"""
    SELECT {sql_time("date_trunc('hour', ts)")} AS ingestion_hour, count(*) AS files_ingested,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_size_bytes,
           count(*) FILTER (event_type <> 'error') AS valid_files, count(*) FILTER (event_type = 'error') AS invalid_files
    FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAYS GROUP BY 1
    """,
)
def ingestion_timeline(spark: SparkSession, folder: str) -> DataFrame:
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    timeline = monitor.ingestion_timeline(captured_events(spark, folder), now)
    return timeline.withColumn("ingestion_hour", time_text("ingestion_hour"))


@query(
    "threshold_alert",
    """
    SELECT 'pending_files' AS metric, CAST(count(*) AS DOUBLE) AS value, 100.0::DOUBLE AS threshold, count(*) > 100 AS breached
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def threshold_alert(spark: SparkSession, folder: str) -> DataFrame:
    from .lifecycle import pending_files

    return monitor.threshold_alert(pending_files(spark, folder), "pending_files", 100)


@query(
    "event_log_recent",
    f"""
    SELECT event_id, {sql_time("ts")} AS timestamp, event_type, CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
           'user ' || user_id AS message, 'flow_' || json_extract_string(props, '$.k') AS flow_name, 'append' AS flow_type
    FROM events WHERE event_type IN ('error', 'signup') ORDER BY ts DESC, event_id DESC LIMIT 100
    """,
)
def event_log_recent(spark: SparkSession, folder: str) -> DataFrame:
    details = F.to_json(
        F.struct(
            F.concat(F.lit("flow_"), F.get_json_object("props", "$.k")).alias("flow_name"), F.lit("append").alias("flow_type")
        )
    )
    log = table(spark, folder, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        "event_type",
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("user "), "user_id").alias("message"),
        details.alias("details"),
    )
    recent = monitor.recent_events(log, ("error", "signup"), 100, tie="event_id")
    return recent.withColumn("timestamp", time_text("timestamp"))


@query(
    "failure_rate_by_method",
    with_ctes(
        EXTRACTED,
        select="""
        SELECT extraction_method_used, count(*) AS documents, count(*) FILTER (extraction_status <> 'success') AS failed,
               round(count(*) FILTER (extraction_status <> 'success') / count(*), 6) AS failure_rate
        FROM extracted GROUP BY extraction_method_used""",
    ),
)
def failure_rate_by_method(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.failure_rate(extracted_view(spark, folder))


@query(
    "method_usage",
    with_ctes(
        DISPATCHED,
        select="""
        SELECT method AS chunking_method_used, count(*) AS uses, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM dispatched GROUP BY method""",
    ),
)
def method_usage(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.method_usage(dispatched_view(spark, folder), "chunking_method_used")


@query(
    "token_outliers",
    with_ctes(
        DISPATCHED,
        f"""
        counted AS (SELECT content_hash, chunk_index, method, {sql_approx_tokens("piece")} AS token_count FROM dispatched),
        fences AS (
          SELECT method, quantile_cont(token_count, 0.25) AS q1, quantile_cont(token_count, 0.75) AS q3 FROM counted GROUP BY method)""",
        select="""
        SELECT content_hash, chunk_index, method AS chunking_method_used, token_count,
               round(q1 - 1.5 * (q3 - q1), 6) AS low_fence, round(q3 + 1.5 * (q3 - q1), 6) AS high_fence
        FROM counted JOIN fences USING (method)
        WHERE token_count < q1 - 1.5 * (q3 - q1) OR token_count > q3 + 1.5 * (q3 - q1)""",
    ),
)
def token_outliers(spark: SparkSession, folder: str) -> DataFrame:
    found = monitor.token_outliers(stored(dispatched_view(spark, folder), "chunks"))
    return found.select(
        "content_hash",
        "chunk_index",
        "chunking_method_used",
        "token_count",
        F.round("low_fence", 6).alias("low_fence"),
        F.round("high_fence", 6).alias("high_fence"),
    )


@query(
    "expectation_report",
    with_ctes(
        DISPATCHED,
        f"""
        counted AS (SELECT piece, {sql_approx_tokens("piece")} AS n FROM dispatched)""",
        select="""
        SELECT 'plausible_tokens' AS expectation, count(*) FILTER (n BETWEEN 5 AND 512) AS passed,
               count(*) FILTER (NOT n BETWEEN 5 AND 512) AS failed FROM counted
        UNION ALL
        SELECT 'ends_a_sentence', count(*) FILTER (piece LIKE '%.'), count(*) FILTER (NOT piece LIKE '%.') FROM counted""",
    ),
)
def expectation_report(spark: SparkSession, folder: str) -> DataFrame:
    expectations = {
        "plausible_tokens": F.col("token_count").between(5, 512),
        "ends_a_sentence": F.endswith("chunk_text", F.lit(".")),
    }
    return monitor.expectation_report(dispatched_view(spark, folder), expectations)
