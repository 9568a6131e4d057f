"""Capture: files, identity, type detection, constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.detect import detect
from ..operators import capture
from ..session import fresh_dir
from ..sources.files import list_files
from ..sources.tables import stored, table
from ..streaming import flows
from .registry import query
from .views import BRONZE, FILES, bronze_view, files_view, sql_time, time_text, with_ctes


@query(
    "bronze_enrich",
    with_ctes(
        FILES,
        BRONZE,
        select=f"""
        SELECT source_path, file_name, file_size, {sql_time("file_modification_time")} AS file_modification_time,
               {sql_time("ingestion_timestamp")} AS ingestion_timestamp, content_hash, file_type,
               source_classification_tag, processing_status FROM bronze""",
    ),
)
def bronze_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return (
        bronze_view(spark, folder)
        .drop("content")
        .withColumn("file_modification_time", time_text("file_modification_time"))
        .withColumn("ingestion_timestamp", time_text("ingestion_timestamp"))
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    from ..functions.identity import content_hash as digest

    return table(spark, folder, "documents").select("doc_id", digest(F.col("text").cast("binary")).alias("content_hash"))


@query(
    "detect_file_type",
    with_ctes(FILES, BRONZE, select="SELECT source_path, file_type, processing_status FROM bronze"),
)
def detect_file_type(spark: SparkSession, folder: str) -> DataFrame:
    files = files_view(spark, folder).select(F.col("path").alias("source_path"), detect(F.col("content")).alias("d"))
    return files.select("source_path", "d.file_type", "d.processing_status")


@query(
    "detect_container",
    with_ctes(
        FILES,
        BRONZE,
        select="""
        SELECT file_type, processing_status, count(*) AS files, CAST(sum(file_size) AS BIGINT) AS bytes FROM bronze
        WHERE file_type IN ('docx', 'xlsx', 'zip_based_unknown') GROUP BY ALL""",
    ),
)
def detect_container(spark: SparkSession, folder: str) -> DataFrame:
    bronze = bronze_view(spark, folder).filter(F.col("file_type").isin("docx", "xlsx", "zip_based_unknown"))
    return bronze.groupBy("file_type", "processing_status").agg(
        F.count("*").alias("files"), F.sum("file_size").alias("bytes")
    )


@query(
    "pdf_integrity",
    with_ctes(
        FILES,
        BRONZE,
        select="SELECT source_path, content_hash, processing_status FROM bronze WHERE file_type = 'pdf'",
    ),
)
def pdf_integrity(spark: SparkSession, folder: str) -> DataFrame:
    pdfs = bronze_view(spark, folder).filter("file_type = 'pdf'")
    return pdfs.select("source_path", "content_hash", "processing_status")


@query(
    "detect_text_files",
    with_ctes(
        FILES,
        BRONZE,
        select="""
        SELECT source_path, CASE WHEN file_type = 'unknown' THEN 'text' ELSE file_type END AS file_type,
               CASE WHEN file_type = 'unknown' THEN 'valid' ELSE processing_status END AS processing_status
        FROM bronze""",
    ),
)
def detect_text_files(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_view(spark, folder, accept_text=True).select("source_path", "file_type", "processing_status")


@query(
    "expect_or_drop",
    """
    SELECT doc_id, sha256(text) AS content_hash FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
    """,
)
def expect_or_drop(spark: SparkSession, folder: str) -> DataFrame:
    kept, _ = capture.expect_or_drop(withheld_rows(spark, folder), "has_content", F.col("content").isNotNull())
    return kept.select("doc_id", F.sha2("content", 256).alias("content_hash"))


@query(
    "expect_or_drop_counts",
    """
    SELECT 'has_content' AS name, count(*) FILTER (NOT withheld) AS passed, count(*) FILTER (withheld) AS failed
    FROM (SELECT doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS withheld FROM documents)
    """,
)
def expect_or_drop_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The rows are written; their counts come from the same pass."""
    kept, seen = capture.expect_or_drop(withheld_rows(spark, folder), "has_content", F.col("content").isNotNull())
    stored(kept, "kept")
    return capture.constraint_counts(spark, {"has_content": seen})


def withheld_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as bytes; those marked toxic have none."""
    withheld = table(spark, folder, "labels").filter("toxic = 1").select("doc_id", F.lit(True).alias("withheld"))
    documents = table(spark, folder, "documents").join(withheld, "doc_id", "left")
    content = F.when(F.col("withheld").isNull(), F.col("text").cast("binary"))
    return documents.select("doc_id", content.alias("content"))


def written_files(spark: SparkSession, folder: str) -> str:
    """The documents as text files on disk, one folder per source."""
    target = fresh_dir(spark, "files")
    lines = table(spark, folder, "documents").select("source", F.regexp_replace("text", "\n", " ").alias("value"))
    lines.write.partitionBy("source").text(target)
    return target


_BYTES_BY_SOURCE = """
SELECT 'source=' || source AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source
"""


@query("file_listing", _BYTES_BY_SOURCE)
def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    listed = list_files(spark, written_files(spark, folder)).select(
        F.try_element_at(F.split("path", "/"), F.lit(-2)).alias("folder"), "length"
    )
    return listed.groupBy("folder").agg(F.sum("length").alias("bytes"))


@query("bronze_file_stream", _BYTES_BY_SOURCE)
def bronze_file_stream(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_dir(spark, "capture")
    flows.finish(flows.capture_flow(spark, written_files(spark, folder), root, max_files=8))
    bronze = flows.read_table(spark, f"{root}/bronze", flows.BRONZE)
    return bronze.groupBy(F.col("source_classification_tag").alias("folder")).agg(F.sum("file_size").alias("bytes"))
