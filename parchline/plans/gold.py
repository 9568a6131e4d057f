"""Access groups, citations, vectors, gold rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vector import hash_embedding as embed
from ..operators import gold
from ..operators.lifecycle import reconcile
from ..session import fresh_dir
from ..sources.tables import delete_keys, read_versioned, spread, table, write_versioned
from .lifecycle import now
from .registry import query
from .views import (
    ACL_MAP,
    FIXED_CHUNKS,
    INSTANCES,
    LIVE,
    TYPED,
    acl_map,
    chunks_view,
    instances_view,
    live_listing,
    sql_hash_number,
    sql_tokens,
    typed_view,
    with_ctes,
)

MODEL = "feature-hash-64"


@query(
    "acl_resolve",
    with_ctes(
        TYPED,
        ACL_MAP,
        INSTANCES,
        select="""
        SELECT source_path, tag AS source_classification_tag, resolved_acl_group, resolved_acl_group IS NULL AS is_unmapped
        FROM instances""",
    ),
)
def acl_resolve(spark: SparkSession, folder: str) -> DataFrame:
    return gold.resolve_acl(typed_view(spark, folder), acl_map(spark, folder)).select(
        "source_path", "source_classification_tag", "resolved_acl_group", "is_unmapped"
    )


@query(
    "source_references",
    with_ctes(
        TYPED,
        select="""
        SELECT content_hash, 0 AS part_no, count(*) AS source_count,
               string_agg(source_path || '=' || file_name, ' ' ORDER BY source_path) AS source_references
        FROM typed GROUP BY content_hash""",
    ),
)
def source_references(spark: SparkSession, folder: str) -> DataFrame:
    parts = gold.reference_parts(instances_view(spark, folder))
    pair = F.transform("source_references", lambda r: F.concat(r["source_path"], F.lit("="), r["file_name"]))
    return parts.select("content_hash", "part_no", "source_count", F.array_join(pair, " ").alias("source_references"))


@query(
    "citations",
    with_ctes(TYPED, select="SELECT content_hash, source_path, file_name FROM typed"),
)
def citations(spark: SparkSession, folder: str) -> DataFrame:
    return gold.citations(instances_view(spark, folder))


_DISTINCT_GROUPS = "count(DISTINCT resolved_acl_group)"


@query(
    "acl_conflict",
    with_ctes(
        TYPED,
        ACL_MAP,
        INSTANCES,
        select=f"""
        SELECT content_hash, CASE WHEN {_DISTINCT_GROUPS} = 1 THEN max(resolved_acl_group) END AS resolved_acl_group,
               {_DISTINCT_GROUPS} > 1 AS acl_conflict_detected FROM instances GROUP BY content_hash""",
    ),
)
def acl_conflict(spark: SparkSession, folder: str) -> DataFrame:
    return gold.acl_by_content(instances_view(spark, folder))


CONTENT_ACL = f"""
content_acl AS (
  SELECT content_hash, arg_max(resolved_acl_group, restrictiveness) AS resolved_acl_group,
         {_DISTINCT_GROUPS} > 1 AS acl_conflict_detected, count(*) AS source_count,
         string_agg(source_path, ' ' ORDER BY source_path) AS sources
  FROM instances GROUP BY content_hash)
"""


@query(
    "acl_most_restrictive",
    with_ctes(
        TYPED,
        ACL_MAP,
        INSTANCES,
        CONTENT_ACL,
        select="SELECT content_hash, resolved_acl_group, acl_conflict_detected FROM content_acl",
    ),
)
def acl_most_restrictive(spark: SparkSession, folder: str) -> DataFrame:
    return gold.acl_most_restrictive(instances_view(spark, folder))


def gold_view(spark: SparkSession, folder: str, active: bool = True) -> DataFrame:
    """Gold over all fixed-window chunks and all (or only the reconciled) instances."""
    current = instances_view(spark, folder)
    if not active:
        current = reconcile(current, live_listing(spark, folder), now())
    return gold.gold_rows(chunks_view(spark, folder), current, MODEL)


@query(
    "gold_join",
    with_ctes(
        FIXED_CHUNKS,
        ACL_MAP,
        INSTANCES,
        CONTENT_ACL,
        select="""
        SELECT chunk_id, content_hash, source_count, sources, resolved_acl_group, acl_conflict_detected
        FROM chunks JOIN content_acl USING (content_hash)""",
    ),
)
def gold_join(spark: SparkSession, folder: str) -> DataFrame:
    return gold_view(spark, folder).select(
        "chunk_id",
        "content_hash",
        "source_count",
        F.array_join("source_references.source_path", " ").alias("sources"),
        "resolved_acl_group",
        "acl_conflict_detected",
    )


VECTORS = f"""
codes AS (
  SELECT id, n % 64 AS b, CAST(sum(CASE WHEN (n // 64) % 2 = 1 THEN -1 ELSE 1 END) AS DOUBLE) AS v FROM (
    SELECT id, {sql_hash_number("tok")} AS n FROM (SELECT id, unnest({sql_tokens("text")}) AS tok FROM texts))
  GROUP BY id, n % 64),
dims AS (SELECT id, b FROM (SELECT id FROM texts), (SELECT unnest(range(64)) AS b)),
vectors AS (
  SELECT id, list(CAST(coalesce(v / nullif(norm, 0), 0) AS FLOAT) ORDER BY b) AS vector
  FROM dims LEFT JOIN codes USING (id, b)
  LEFT JOIN (SELECT id, sqrt(sum(v * v)) AS norm FROM codes GROUP BY id) USING (id) GROUP BY id)
"""

_VECTOR_TEXT = "array_to_string(list_transform(vector, lambda x: printf('%.4f', abs(round(CAST(x AS DOUBLE), 4)))), ' ')"


def vector_text(vector: str):
    """Magnitudes to four digits, as text (no signed zeros to differ about)."""
    return F.array_join(F.transform(vector, lambda x: F.format_string("%.4f", F.abs(F.round(x.cast("double"), 4)))), " ")


@query(
    "hash_embedding",
    with_ctes(
        "texts AS (SELECT doc_id AS id, text FROM documents)",
        VECTORS,
        select=f"""
        SELECT id AS doc_id, {_VECTOR_TEXT} AS magnitudes,
               len(list_filter(vector, lambda x: x < 0)) AS negatives FROM vectors""",
    ),
)
def hash_embedding(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spread(table(spark, folder, "documents")).select("doc_id", embed(F.col("text")).alias("v"))
    return vectors.select(
        "doc_id",
        vector_text("v").alias("magnitudes"),
        F.size(F.filter("v", lambda x: x < 0)).cast("bigint").alias("negatives"),
    )


_GOLD_SELECT = f"""
SELECT chunk_id, md5(chunk_text) AS text_md5, {_VECTOR_TEXT} AS vector, '{MODEL}' AS embedding_model, sources, source_count,
       content_hash, resolved_acl_group, acl_conflict_detected, 'fixed_size_with_overlap' AS chunking_method_used,
       'plain_text_decode' AS extraction_method_used
FROM chunks JOIN content_acl USING (content_hash) JOIN vectors ON id = chunk_id
"""
_TEXTS = "texts AS (SELECT chunk_id AS id, chunk_text AS text FROM chunks)"


@query("gold_projection", with_ctes(FIXED_CHUNKS, ACL_MAP, INSTANCES, CONTENT_ACL, _TEXTS, VECTORS, select=_GOLD_SELECT))
def gold_projection(spark: SparkSession, folder: str) -> DataFrame:
    return gold_view(spark, folder).select(
        "chunk_id",
        F.md5("chunk_text").alias("text_md5"),
        vector_text("embedding_vector").alias("vector"),
        "embedding_model",
        F.array_join("source_references.source_path", " ").alias("sources"),
        "source_count",
        "content_hash",
        "resolved_acl_group",
        "acl_conflict_detected",
        "chunking_method_used",
        "extraction_method_used",
    )


SERVED_GOLD = "chunk_id string, content_hash string, chunk_text string"


@query(
    "gold_after_delete",
    with_ctes(
        FIXED_CHUNKS,
        LIVE,
        select="""
        SELECT chunk_id, content_hash FROM chunks
        WHERE content_hash IN (SELECT content_hash FROM typed JOIN live ON path = source_path)""",
    ),
)
def gold_after_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Gold written as a versioned table; orphans are deleted by rewriting the buckets that hold them."""
    current = reconcile(instances_view(spark, folder), live_listing(spark, folder), now())
    served = fresh_dir(spark, "gold-served")
    rows = gold_view(spark, folder).select("chunk_id", "content_hash", "chunk_text")
    write_versioned(rows, served, "content_hash")
    orphans = gold.orphan_keys(read_versioned(spark, served, SERVED_GOLD), current)
    delete_keys(spark, served, orphans, "content_hash", SERVED_GOLD)
    return read_versioned(spark, served, SERVED_GOLD).select("chunk_id", "content_hash")
