"""Whole files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """All files below a folder with their bytes."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of all files; the bytes are pruned and never read."""
    return read_files(spark, path).select("path", "length", "modificationTime")


def stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files as they arrive. Zero-length files are skipped by the file source."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
