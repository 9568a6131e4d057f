"""Bronze: file rows become identified, typed document rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.detect import detect, with_plain_text
from ..functions.identity import content_hash, path_part


def enrich(files: DataFrame, ingested_at: Column | None = None, accept_text: bool = False) -> DataFrame:
    """``path, modificationTime, length, content`` to the bronze schema. One narrow pass."""
    found = detect(F.col("content"))
    if accept_text:
        found = with_plain_text(found, F.col("content"))
    return (
        files.withColumn("found", found)
        .select(
            "content",
            F.col("path").alias("source_path"),
            path_part(F.col("path"), 1).alias("file_name"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_modification_time"),
            (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingestion_timestamp"),
            content_hash(F.col("content")).alias("content_hash"),
            F.col("found.file_type").alias("file_type"),
            path_part(F.col("path"), 2).alias("source_classification_tag"),
            F.col("found.processing_status").alias("processing_status"),
        )
    )


def expect_or_drop(df: DataFrame, name: str, condition: Column) -> tuple[DataFrame, Observation]:
    """Keep rows that satisfy the condition; pass and fail counts are observed on the way."""
    seen = Observation(name)
    holds = F.coalesce(condition, F.lit(False))
    counted = df.observe(seen, F.count_if(holds).alias("passed"), F.count_if(~holds).alias("failed"))
    return counted.filter(condition), seen


def constraint_counts(spark: SparkSession, seen: dict[str, Observation]) -> DataFrame:
    """``name, passed, failed`` of constraints, one row each; the constrained rows must have been written."""
    rows = [(name, counts["passed"], counts["failed"]) for name, counts in ((n, o.get) for n, o in seen.items())]
    return spark.createDataFrame(rows, "name string, passed bigint, failed bigint")


def valid_only(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("processing_status") == "valid")
