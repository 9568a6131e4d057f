"""Rules, sections and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.binding import explode_rows
from ..functions.text import approx_tokens, fixed_pieces, sentences, structured_pieces
from ..functions.vector import adjacent_cosine
from ..operators import chunks as chunking
from ..operators import sections as sec
from ..operators.rules import CHUNKING_RULES, resolve_chunking, resolve_extraction, resolve_retrieval
from ..sources.tables import spread, stored, table
from .registry import query
from .views import (
    EXTRACTED,
    EXTRACTION_CONFIG,
    FIXED_CHUNKS,
    TYPED,
    chunks_view,
    dispatched_view,
    extracted_view,
    sql_approx_tokens,
    sql_hash_number,
    sql_strip,
    sql_tokens,
    sql_windows,
    typed_view,
    with_ctes,
)

# --- rules --------------------------------------------------------------------------------------


@query(
    "resolve_extraction",
    with_ctes(
        TYPED,
        select="""
        SELECT source_path, file_type,
               CASE WHEN file_type = 'pdf' AND contains(source_path, '/src1/') THEN 'azure_document_intelligence_ocr'
                    WHEN file_type = 'docx' AND contains(source_path, '/src2/') THEN 'custom_reader'
                    WHEN file_type = 'pdf' THEN 'pymupdf_standard' WHEN file_type = 'docx' THEN 'python_docx_standard'
                    WHEN file_type = 'xlsx' THEN 'openpyxl_standard' ELSE 'plain_text_decode' END AS extraction_method,
               CASE WHEN file_type = 'docx' AND contains(source_path, '/src2/') THEN 'partial' ELSE 'atomic' END AS on_failure,
               CASE WHEN (file_type = 'pdf' AND contains(source_path, '/src1/'))
                      OR (file_type = 'docx' AND contains(source_path, '/src2/')) THEN 'override' ELSE 'default' END AS matched_rule
        FROM typed""",
    ),
)
def resolve_extraction_methods(spark: SparkSession, folder: str) -> DataFrame:
    return resolve_extraction(typed_view(spark, folder).select("source_path", "file_type"), EXTRACTION_CONFIG)


@query(
    "resolve_chunking",
    with_ctes(
        EXTRACTED,
        select="""
        SELECT content_hash,
               CASE WHEN extraction_method_used = 'azure_document_intelligence_ocr' THEN 'semantic_split'
                    WHEN file_type = 'pdf' THEN 'recursive_structure_aware' WHEN file_type = 'docx' THEN 'heading_hierarchy_split'
                    WHEN file_type = 'xlsx' THEN 'table_aware_row_based' ELSE 'fixed_size_with_overlap' END AS chunking_method,
               CASE WHEN extraction_method_used = 'azure_document_intelligence_ocr' THEN 256
                    WHEN file_type = 'xlsx' THEN -1 ELSE 512 END AS chunk_size,
               CASE WHEN extraction_method_used = 'azure_document_intelligence_ocr' THEN 25
                    WHEN file_type = 'xlsx' THEN -1 ELSE 50 END AS overlap,
               CASE WHEN extraction_method_used = 'azure_document_intelligence_ocr' THEN 'override' ELSE 'default' END AS matched_rule
        FROM extracted""",
    ),
)
def resolve_chunking_methods(spark: SparkSession, folder: str) -> DataFrame:
    found = extracted_view(spark, folder).select("content_hash", "file_type", "extraction_method_used")
    return resolve_chunking(found).select(
        "content_hash",
        "chunking_method",
        F.coalesce("chunk_size", F.lit(-1)).alias("chunk_size"),
        F.coalesce("overlap", F.lit(-1)).alias("overlap"),
        "matched_rule",
    )


def requests_view(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items as search requests, each sent to one of three endpoints."""
    place = F.col("item_id") % 3
    endpoint = F.when(place == 0, "quick-lookup-bot").when(place == 1, "deep-research-tool").otherwise("help-desk")
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text", endpoint.alias("endpoint_name"))


REQUESTS = """
requests AS (
  SELECT item_id AS query_id, text, CASE item_id % 3 WHEN 0 THEN 'quick-lookup-bot' WHEN 1 THEN 'deep-research-tool'
                                    ELSE 'help-desk' END AS endpoint_name FROM benchmark)
"""


@query(
    "resolve_retrieval",
    with_ctes(
        REQUESTS,
        select="""
        SELECT query_id, endpoint_name, 'hybrid' AS query_type,
               CASE endpoint_name WHEN 'deep-research-tool' THEN 50 ELSE 20 END AS retrieval_top_k,
               CASE endpoint_name WHEN 'deep-research-tool' THEN 10 WHEN 'quick-lookup-bot' THEN 3 ELSE 5 END AS final_top_k,
               true AS rerank, endpoint_name <> 'quick-lookup-bot' AS query_rewrite FROM requests""",
    ),
)
def resolve_retrieval_settings(spark: SparkSession, folder: str) -> DataFrame:
    return resolve_retrieval(requests_view(spark, folder)).drop("text")


# --- sections -----------------------------------------------------------------------------------


@query(
    "text_decode",
    f"""
    SELECT doc_id, CASE WHEN toxic THEN 'corrupt' WHEN {sql_strip("text")} = '' THEN 'empty' ELSE 'success' END AS status,
           CASE WHEN toxic THEN '' ELSE md5({sql_strip("text")}) END AS text_md5,
           CASE WHEN toxic OR {sql_strip("text")} = '' THEN 0 ELSE 1 END AS n_sections
    FROM (SELECT doc_id, text, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM documents)
    """,
)
def text_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled toxic documents get a byte that is not UTF-8."""
    toxic = table(spark, folder, "labels").filter("toxic = 1").select("doc_id", F.lit(b"\xff\x41").alias("junk"))
    documents = table(spark, folder, "documents").join(toxic, "doc_id", "left")
    content = F.concat(F.col("text").cast("binary"), F.coalesce("junk", F.lit(b"")))
    out = documents.select("doc_id", sec.decode_text(content).alias("r"))
    return out.select(
        "doc_id",
        "r.status",
        F.when(F.col("r.status") == "corrupt", "").otherwise(F.md5("r.full_text")).alias("text_md5"),
        F.size("r.sections").alias("n_sections"),
    )


def page_sections_view(spark: SparkSession, folder: str) -> DataFrame:
    return sec.page_table(table(spark, folder, "conversations"), "conv_id", "turn", "text")


@query(
    "page_sections",
    f"SELECT conv_id, CAST(turn AS INTEGER) AS position, CAST(NULL AS VARCHAR) AS heading, {sql_strip('text')} AS text FROM conversations",
)
def page_sections(spark: SparkSession, folder: str) -> DataFrame:
    return page_sections_view(spark, folder)


@query(
    "page_full_text",
    f"""
    SELECT conv_id, 0 AS part_no, string_agg({sql_strip("text")}, chr(10) || chr(10) ORDER BY turn) AS full_text,
           CASE WHEN bool_or({sql_strip("text")} <> '') THEN 'success' ELSE 'empty' END AS extraction_status,
           count(*) AS n_sections
    FROM conversations GROUP BY conv_id
    """,
)
def page_full_text(spark: SparkSession, folder: str) -> DataFrame:
    sections = page_sections_view(spark, folder)
    return sec.full_text_table(sections, "conv_id").join(sec.document_status(sections, "conv_id"), "conv_id")


HEADING_SECTIONS = f"""
turns AS (
  SELECT conv_id, turn, {sql_strip("text")} AS t, role = 'user' AS h FROM conversations WHERE {sql_strip("text")} <> ''),
marked AS (
  SELECT *, sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM turns),
heading_sections AS (
  SELECT b.conv_id, CAST(row_number() OVER (PARTITION BY b.conv_id ORDER BY b.g) - 1 AS INTEGER) AS position,
         m.t AS heading, b.t AS text
  FROM (SELECT conv_id, g, string_agg(t, chr(10) ORDER BY turn) AS t FROM marked WHERE NOT h GROUP BY conv_id, g) b
  LEFT JOIN marked m ON m.conv_id = b.conv_id AND m.g = b.g AND m.h)
"""


def heading_sections_view(spark: SparkSession, folder: str) -> DataFrame:
    return sec.heading_table(
        table(spark, folder, "conversations"), "conv_id", "turn", "text", F.col("role") == "user"
    )


@query("heading_sections", with_ctes(HEADING_SECTIONS, select="SELECT *, 0 AS part_no FROM heading_sections"))
def heading_sections(spark: SparkSession, folder: str) -> DataFrame:
    return heading_sections_view(spark, folder)


_PART_COLUMNS = ("p_name", "p_brand", "p_type", "p_size")
_SQL_ROW = " || ', ' || ".join(f"'{c}: ' || {c}" for c in _PART_COLUMNS)
ROW_SECTIONS = f"""
row_sections AS (
  SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS position, 'part' AS heading, {_SQL_ROW} AS text FROM part)
"""


def row_sections_view(spark: SparkSession, folder: str) -> DataFrame:
    return sec.row_table(table(spark, folder, "part"), "part", "p_partkey", list(_PART_COLUMNS))


@query("row_sections", with_ctes(ROW_SECTIONS, select="SELECT * FROM row_sections"))
def row_sections(spark: SparkSession, folder: str) -> DataFrame:
    return row_sections_view(spark, folder)


@query(
    "line_page_sections",
    """
    SELECT conv_id, turn, 0 AS part_no, string_agg(line, chr(10) ORDER BY i) AS text FROM (
      SELECT conv_id, turn, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
      FROM (SELECT conv_id, turn, regexp_split_to_array(text, '\\. ') AS parts FROM conversations))
    GROUP BY conv_id, turn
    """,
)
def line_page_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as pages, their sentences as recognised lines."""
    lines = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split("text", r"\. ", -1)).alias("line_no", "line")
    )
    return sec.line_page_table(lines, ["conv_id", "turn"], "line_no", "line").withColumnRenamed("line", "text")


_DIGEST = "md5(string_agg(coalesce(heading, '') || '|' || t || '|' || position, chr(10) ORDER BY position))"


@query(
    "extract_dispatch",
    with_ctes(
        EXTRACTED,
        select=f"""
        SELECT content_hash, file_type, extraction_method_used, extraction_status, md5(full_text) AS full_text_md5,
               error_message, CAST(coalesce(n, 0) AS INTEGER) AS n_sections, coalesce(digest, md5('')) AS sections_md5
        FROM extracted LEFT JOIN (SELECT content_hash, count(*) AS n, {_DIGEST} AS digest FROM sections GROUP BY content_hash)
          USING (content_hash)""",
    ),
)
def extract_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    line = F.transform(
        "sections", lambda s: F.concat_ws("|", F.coalesce(s["heading"], F.lit("")), s["text"], s["position"].cast("string"))
    )
    return extracted_view(spark, folder).select(
        "content_hash",
        "file_type",
        "extraction_method_used",
        "extraction_status",
        F.md5("full_text").alias("full_text_md5"),
        "error_message",
        F.size("sections").alias("n_sections"),
        F.md5(F.array_join(line, "\n")).alias("sections_md5"),
    )


@query(
    "failure_policy",
    """
    WITH parts AS (
      SELECT conv_id, turn, text, role, length(text) > 400 AS bad,
             CASE WHEN bool_or(role = 'system') OVER (PARTITION BY conv_id) THEN 'partial' ELSE 'atomic' END AS on_failure
      FROM conversations)
    SELECT conv_id, turn, on_failure, on_failure = 'partial' AND conv_id IN (SELECT conv_id FROM parts WHERE bad) AS is_partial
    FROM parts WHERE NOT bad AND (on_failure = 'partial' OR conv_id NOT IN (SELECT conv_id FROM parts WHERE bad))
    """,
)
def failure_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Overlong turns are bad parts; conversations with a system turn opted into ``partial``."""
    turns = table(spark, folder, "conversations")
    opted = turns.filter("role = 'system'").select("conv_id").distinct().withColumn("opted", F.lit(True))
    policy = F.when(F.col("opted"), "partial").otherwise("atomic")
    kept = sec.apply_failure_policy(turns.join(opted, "conv_id", "left"), "conv_id", F.length("text") > 400, policy)
    return kept.select("conv_id", "turn", "on_failure", "is_partial")


# --- chunks -------------------------------------------------------------------------------------


@query("approx_tokens", f"SELECT doc_id, {sql_approx_tokens('text')} AS token_count FROM documents")
def token_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", approx_tokens(F.col("text")).alias("token_count"))


@query(
    "chunk_fixed",
    f"""
    SELECT doc_id, CAST(w AS INTEGER) AS chunk_index, piece AS chunk_text, {sql_approx_tokens("piece")} AS token_count
    FROM ({sql_windows("documents", "doc_id", "text")})
    """,
)
def chunk_fixed(spark: SparkSession, folder: str) -> DataFrame:
    cut = spread(table(spark, folder, "documents")).withColumn("pieces", fixed_pieces(F.col("text"), 512, 50))
    pieces = explode_rows(cut, "pieces", "doc_id", index="chunk_index", value="chunk_text")
    return pieces.withColumn("token_count", approx_tokens(F.col("chunk_text")))


@query(
    "chunk_fixed_sections",
    f"""
    SELECT conv_id, CAST(w AS INTEGER) AS chunk_index, piece AS chunk_text, {sql_approx_tokens("piece")} AS token_count
    FROM ({sql_windows("(SELECT conv_id, string_agg(t, chr(10) || chr(10) ORDER BY turn) AS text FROM "
                       f"(SELECT conv_id, turn, {sql_strip('text')} AS t FROM conversations) WHERE t <> '' GROUP BY conv_id)",
                       "conv_id", "text", 100, 60)})
    """,
)
def chunk_fixed_sections(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.fixed_table(page_sections_view(spark, folder), "conv_id", 100, 60)


@query(
    "chunk_id",
    with_ctes(FIXED_CHUNKS, select="SELECT chunk_id, content_hash, chunk_index, md5(chunk_text) AS text_md5, token_count FROM chunks"),
)
def chunk_identity(spark: SparkSession, folder: str) -> DataFrame:
    return chunks_view(spark, folder).select(
        "chunk_id", "content_hash", "chunk_index", F.md5("chunk_text").alias("text_md5"), "token_count"
    )


def sql_structured(sections: str, doc: str, size: int, overlap: int) -> str:
    """Structure-aware chunks of ``doc, position, heading, t``: by section, paragraph, window."""
    window = size * 4
    return f"""
      SELECT {doc}, CAST(row_number() OVER (PARTITION BY {doc} ORDER BY position, p, w) - 1 AS INTEGER) AS chunk_index,
             heading, piece FROM (
        {sql_windows(f'''(
          SELECT {doc}, position, heading, 0 AS p, t FROM {sections} WHERE t <> '' AND length(t) <= {window}
          UNION ALL
          SELECT {doc}, position, heading, p, t FROM (
            SELECT {doc}, position, heading, generate_subscripts(parts, 1) AS p, unnest(parts) AS t
            FROM (SELECT *, string_split(t, chr(10) || chr(10)) AS parts FROM {sections} WHERE length(t) > {window}))
          WHERE {sql_strip("t")} <> '')''', f"{doc}, position, heading, p", "t", size, overlap)})"""


@query(
    "chunk_recursive",
    f"""
    SELECT doc_id, chunk_index, piece AS chunk_text, {sql_approx_tokens("piece")} AS token_count FROM (
      {sql_structured("(SELECT doc_id, 0 AS position, NULL AS heading, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents)",
                      "doc_id", 512, 50)})
    """,
)
def chunk_recursive(spark: SparkSession, folder: str) -> DataFrame:
    text = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    cut = spread(table(spark, folder, "documents")).withColumn("t", text).withColumn(
        "pieces", structured_pieces(F.col("t"), 512, 50)
    )
    pieces = explode_rows(cut, "pieces", "doc_id", index="chunk_index", value="chunk_text")
    return pieces.withColumn("token_count", approx_tokens(F.col("chunk_text")))


@query(
    "chunk_heading",
    with_ctes(
        HEADING_SECTIONS,
        select=f"""
        SELECT conv_id, chunk_index, piece AS chunk_text, heading AS section_heading, {sql_approx_tokens("piece")} AS token_count
        FROM ({sql_structured("(SELECT conv_id, position, heading, text AS t FROM heading_sections)", "conv_id", 64, 16)})""",
    ),
)
def chunk_heading(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.structured_table(heading_sections_view(spark, folder), "conv_id", 64, 16)


@query(
    "chunk_rows",
    with_ctes(
        ROW_SECTIONS,
        select=f"""
        SELECT position AS chunk_index, text AS chunk_text, heading AS section_heading,
               {sql_approx_tokens("text")} AS token_count FROM row_sections""",
    ),
)
def chunk_rows(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.row_chunk_table(row_sections_view(spark, folder))


def sql_semantic(source: str, doc: str, size: int = 256, overlap: int = 25, threshold: float = 0.1) -> list[str]:
    """Semantic chunks of ``doc, t`` as CTEs ending in ``semantic(doc, chunk_index, piece)``."""
    return [
        f"""
        sents AS (
          SELECT {doc}, row_number() OVER (PARTITION BY {doc} ORDER BY i) AS s, t FROM (
            SELECT {doc}, generate_subscripts(parts, 1) AS i, {sql_strip("unnest(parts)")} AS t FROM (
              SELECT {doc}, string_split(regexp_replace(t, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM {source}))
          WHERE t <> ''),
        buckets AS (
          SELECT {doc}, s, n % 64 AS b, CAST(sum(CASE WHEN (n // 64) % 2 = 1 THEN -1 ELSE 1 END) AS DOUBLE) AS v FROM (
            SELECT {doc}, s, {sql_hash_number("tok")} AS n FROM (
              SELECT {doc}, s, unnest({sql_tokens("t")}) AS tok FROM sents))
          GROUP BY {doc}, s, n % 64),
        power AS (SELECT {doc}, s, sum(v * v) AS p FROM buckets GROUP BY {doc}, s),
        dots AS (
          SELECT a.{doc}, a.s, sum(a.v * b.v) AS d FROM buckets a
          JOIN buckets b ON b.{doc} = a.{doc} AND b.s = a.s - 1 AND b.b = a.b GROUP BY a.{doc}, a.s),
        turns AS (
          SELECT t.{doc}, t.s, t.t, CASE WHEN t.s = 1 THEN 1
                 WHEN coalesce(d.d / nullif(sqrt(p.p * q.p), 0), 0) < {threshold} THEN 1 ELSE 0 END AS turn
          FROM sents t LEFT JOIN dots d ON d.{doc} = t.{doc} AND d.s = t.s
          LEFT JOIN power p ON p.{doc} = t.{doc} AND p.s = t.s LEFT JOIN power q ON q.{doc} = t.{doc} AND q.s = t.s - 1),
        topics AS (
          SELECT {doc}, g, string_agg(t, ' ' ORDER BY s) AS t
          FROM (SELECT *, sum(turn) OVER (PARTITION BY {doc} ORDER BY s) AS g FROM turns) GROUP BY {doc}, g),
        semantic AS (
          SELECT {doc}, CAST(row_number() OVER (PARTITION BY {doc} ORDER BY g, w) - 1 AS INTEGER) AS chunk_index, piece
          FROM ({sql_windows("topics", f"{doc}, g", "t", size, overlap)}))"""
    ]


@query(
    "chunk_semantic",
    with_ctes(
        *sql_semantic("(SELECT doc_id, text AS t FROM documents)", "doc_id"),
        select=f"SELECT doc_id, chunk_index, piece AS chunk_text, {sql_approx_tokens('piece')} AS token_count FROM semantic",
    ),
)
def chunk_semantic(spark: SparkSession, folder: str) -> DataFrame:
    split = spread(table(spark, folder, "documents")).select("doc_id", sentences(F.col("text")).alias("s"))
    scored = split.withColumn("similarity", adjacent_cosine(F.col("s")))
    pieces = chunking.semantic_chunks(F.col("s"), F.col("similarity"), 256, 25, chunking.SEMANTIC_THRESHOLD)
    rows = explode_rows(scored.withColumn("pieces", pieces), "pieces", "doc_id", value="p")
    return rows.select(
        "doc_id",
        F.col("p.index").alias("chunk_index"),
        F.col("p.text").alias("chunk_text"),
        approx_tokens(F.col("p.text")).alias("token_count"),
    )


def _sections_of(method: str) -> str:
    return (
        "(SELECT content_hash, position, heading, t FROM sections JOIN extracted USING (content_hash) "
        f"WHERE extraction_method_used = '{method}' AND extraction_status = 'success')"
    )


_OCR = _sections_of("azure_document_intelligence_ocr")
_TEXT = _sections_of("plain_text_decode")
DISPATCHED = ",\n".join(
    [
        EXTRACTED,
        *sql_semantic(_OCR, "content_hash"),
        f"""
        dispatched AS (
          SELECT content_hash, chunk_index, piece, heading, 'recursive_structure_aware' AS method
          FROM ({sql_structured(_sections_of("pymupdf_standard"), "content_hash", 512, 50)})
          UNION ALL
          SELECT content_hash, chunk_index, piece, heading, 'heading_hierarchy_split'
          FROM ({sql_structured(_sections_of("python_docx_standard"), "content_hash", 512, 50)})
          UNION ALL
          SELECT content_hash, CAST(position AS INTEGER), t, heading, 'table_aware_row_based' FROM {_sections_of("openpyxl_standard")}
          UNION ALL
          SELECT content_hash, CAST(w AS INTEGER), piece, NULL, 'fixed_size_with_overlap'
          FROM ({sql_windows(_TEXT, "content_hash", "t")})
          UNION ALL
          SELECT content_hash, chunk_index, piece, NULL, 'semantic_split' FROM semantic)""",
    ]
)
_DISPATCH_SQL = with_ctes(
    DISPATCHED,
    select=f"""
    SELECT sha256(content_hash || '_' || chunk_index) AS chunk_id, content_hash, chunk_index, md5(piece) AS text_md5,
           heading AS section_heading, method AS chunking_method_used, extraction_method_used,
           {sql_approx_tokens("piece")} AS token_count
    FROM dispatched JOIN extracted USING (content_hash)""",
)


def chunk_digest(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id",
        "content_hash",
        "chunk_index",
        F.md5("chunk_text").alias("text_md5"),
        "section_heading",
        "chunking_method_used",
        "extraction_method_used",
        "token_count",
    )


@query("chunk_dispatch", _DISPATCH_SQL)
def chunk_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_digest(dispatched_view(spark, folder))


@query(
    "rechunk",
    with_ctes(
        EXTRACTED,
        select=f"""
        SELECT sha256(content_hash || '_' || w) AS chunk_id, content_hash, CAST(w AS INTEGER) AS chunk_index, md5(piece) AS text_md5
        FROM ({sql_windows("(SELECT content_hash, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY position) FILTER (t <> ''), '') AS t FROM extracted "
                           "LEFT JOIN sections USING (content_hash) WHERE extraction_status = 'success' GROUP BY content_hash)",
                           "content_hash", "t", 128, 16)})""",
    ),
)
def rechunk(spark: SparkSession, folder: str) -> DataFrame:
    """Another chunking over the stored extraction table: no file is read or extracted again."""
    rule = {"method": "fixed_size_with_overlap", "chunk_size": 128, "overlap": 16}
    again = {"chunking": {"defaults": dict.fromkeys(("pdf", "docx", "xlsx", "text"), rule)}}
    return chunking.chunk(stored(extracted_view(spark, folder), "extracted"), again).select(
        "chunk_id", "content_hash", "chunk_index", F.md5("chunk_text").alias("text_md5")
    )


@query(
    "chunkless_documents",
    with_ctes(
        EXTRACTED,
        select="""
        SELECT content_hash, file_type, extraction_method_used FROM extracted
        WHERE extraction_status = 'success' AND (extraction_method_used = 'azure_document_intelligence_ocr'
              OR content_hash NOT IN (SELECT content_hash FROM sections WHERE t <> ''))""",
    ),
)
def chunkless_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Under rules whose OCR override names no known method, its documents yield no chunk."""
    body = CHUNKING_RULES["chunking"]
    override = {"extraction_method_used": "azure_document_intelligence_ocr", "method": "not_there"}
    extracted = stored(extracted_view(spark, folder), "extracted")
    produced = chunking.chunk(extracted, {"chunking": {"defaults": body["defaults"], "overrides": [override]}})
    return chunking.chunkless(extracted, produced)
