"""Access groups, citations and the servable gold rows."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vector import hash_embedding

# So many citations are gathered in one part of ``reference_parts``; a gold row carries those of all parts.
PART_REFERENCES = 1000


def resolve_acl(documents: DataFrame, mapping: DataFrame, tag: str = "source_classification_tag") -> DataFrame:
    """Raw tag to access group; an unmapped tag stays visible and gets no group.

    The mapping is a dimension; AQE broadcasts it where its measured size allows.
    """
    named = mapping.select(F.col("tag").alias(tag), F.col("acl_group").alias("_group"), "restrictiveness")
    joined = documents.drop("resolved_acl_group").join(named, tag, "left")
    return joined.withColumnRenamed("_group", "resolved_acl_group").withColumn(
        "is_unmapped", F.col("resolved_acl_group").isNull()
    )


def acl_by_content(current: DataFrame) -> DataFrame:
    """One group per content; several distinct groups are a conflict and give NULL.

    Smallest and largest group decide it, so nothing is collected.
    """
    low, high = F.min("resolved_acl_group"), F.max("resolved_acl_group")
    return current.filter("is_active").groupBy("content_hash").agg(
        F.when(low == high, low).alias("resolved_acl_group"),
        F.coalesce(low != high, F.lit(False)).alias("acl_conflict_detected"),
    )


def acl_most_restrictive(current: DataFrame) -> DataFrame:
    """The most restrictive group wins (ties: the later name) and the conflict stays flagged."""
    low, high = F.min("resolved_acl_group"), F.max("resolved_acl_group")
    strictest = F.max(
        F.when(F.col("resolved_acl_group").isNotNull(), F.struct("restrictiveness", "resolved_acl_group"))
    )
    return current.filter("is_active").groupBy("content_hash").agg(
        strictest["resolved_acl_group"].alias("resolved_acl_group"),
        F.coalesce(low != high, F.lit(False)).alias("acl_conflict_detected"),
    )


def citations(current: DataFrame) -> DataFrame:
    """Every source a content is known under, one row each."""
    return current.filter("is_active").select("content_hash", "source_path", "file_name").distinct()


def reference_parts(current: DataFrame, per_part: int = PART_REFERENCES) -> DataFrame:
    """Citations packed as ``content_hash, part_no, n_parts, source_count, source_references``.

    A content with up to ``per_part`` sources is one row. One with more is split by path hash into
    parts of about that many, so no row and no task gathers an unbounded set and none is lost.
    """
    rows = citations(current)
    counts = rows.groupBy("content_hash").agg(F.count("*").alias("source_count"))
    # Only contents beyond one part need their count at the row; they are few by construction.
    many = counts.filter(F.col("source_count") > per_part)
    n_parts = F.coalesce(F.ceil(F.col("source_count") / F.lit(per_part)), F.lit(1)).cast("int")
    placed = rows.join(many, "content_hash", "left").select(
        "content_hash",
        F.struct("source_path", "file_name").alias("ref"),
        n_parts.alias("n_parts"),
        F.col("source_count").alias("_many"),
        F.pmod(F.xxhash64("source_path"), n_parts).cast("int").alias("part_no"),
    )
    packed = placed.groupBy("content_hash", "part_no").agg(
        F.max("n_parts").alias("n_parts"),
        F.max("_many").alias("_many"),
        F.array_sort(F.collect_list("ref")).alias("source_references"),
    )
    return packed.select(
        "content_hash",
        "part_no",
        "n_parts",
        F.coalesce("_many", F.size("source_references")).cast("bigint").alias("source_count"),
        "source_references",
    )


def all_references(current: DataFrame, per_part: int = PART_REFERENCES) -> DataFrame:
    """Every citation of a content in one ordered row: ``content_hash, source_count, source_references``.

    The last step gathers parts, not instances, so a hot content sends it one row per part.
    """
    return reference_parts(current, per_part).groupBy("content_hash").agg(
        F.max("source_count").alias("source_count"),
        F.array_sort(F.flatten(F.collect_list("source_references"))).alias("source_references"),
    )


def gold_rows(
    chunks: DataFrame,
    current: DataFrame,
    model: str,
    embed: Callable[[Column], Column] = hash_embedding,
    acl: Callable[[DataFrame], DataFrame] = acl_most_restrictive,
    per_part: int = PART_REFERENCES,
) -> DataFrame:
    """Active chunks with all their citations, access group and vector.

    Instances are reduced to one row per content before the join, so chunks are not multiplied.
    """
    content = acl(current).join(all_references(current, per_part), "content_hash", "left")
    return (
        chunks.filter("is_active")
        .join(content, "content_hash")
        .select(
            "chunk_id",
            "chunk_text",
            embed(F.col("chunk_text")).alias("embedding_vector"),
            F.lit(model).alias("embedding_model"),
            F.current_timestamp().alias("embedded_at"),
            "source_references",
            "source_count",
            "content_hash",
            "section_heading",
            "resolved_acl_group",
            "acl_conflict_detected",
            "chunking_method_used",
            "extraction_method_used",
        )
    )


def drop_orphans(gold: DataFrame, current: DataFrame) -> DataFrame:
    """Gold without the rows of content that has no active instance left."""
    return gold.join(current.filter("is_active").select("content_hash").distinct(), "content_hash", "left_semi")


def orphan_keys(gold: DataFrame, current: DataFrame) -> DataFrame:
    """Contents in gold without an active instance left: those whose rows a physical delete removes."""
    active = current.filter("is_active").select("content_hash").distinct()
    return gold.select("content_hash").distinct().join(active, "content_hash", "left_anti")
