"""The given tables seen as files, bronze rows, instances and access maps.

Each view exists twice: as a DataFrame and as a SQL common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.identity import content_hash
from ..operators.capture import enrich
from ..operators.chunks import chunk, chunk_rows, fixed_chunks
from ..operators.sections import extract, text_sections
from ..sources.tables import spread, table

SIZE, OVERLAP = 512, 50
WINDOW, STEP = SIZE * 4, (SIZE - OVERLAP) * 4


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')"


def sql_approx_tokens(text: str) -> str:
    return f"CAST(greatest(1, round_even(length({text}) / 4.0, 0)) AS INTEGER)"


def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def time_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def sql_hash_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


# --- files: every document dressed as a file, its kind decided by its own length ------------------

_PDF_HEAD = b"%PDF-1.7\n"
_PDF_TAIL = b"\n1 0 obj<</Type /Page>>endobj\nstartxref\n0\n%%EOF"


def _zip_tail(member: str) -> bytes:
    """A member list with one name, and the end record that points at it."""
    name = member.encode()
    entry = b"PK\x01\x02" + bytes(24) + len(name).to_bytes(2, "little") + bytes(16) + name
    end = b"PK\x05\x06" + bytes(4) + b"\x01\x00\x01\x00" + len(entry).to_bytes(4, "little") + bytes(6)
    return entry + end


_DOCX_TAIL, _XLSX_TAIL, _OTHER_TAIL = (
    _zip_tail(m) for m in ("word/document.xml", "xl/workbook.xml", "misc/readme.txt")
)
_ZIP_HEAD = b"PK\x03\x04"


def files_view(spark: SparkSession, folder: str) -> DataFrame:
    """``path, modificationTime, length, content`` with every branch of type detection."""
    documents = spread(table(spark, folder, "documents"))
    text = F.col("text").cast("binary")
    kind = F.length("text") % 10

    def wrap(head: bytes, tail: bytes):
        return F.concat(F.lit(head), text, F.lit(tail))

    content = (
        F.when(kind < 2, wrap(_PDF_HEAD, _PDF_TAIL))
        .when(kind == 2, wrap(_PDF_HEAD, b""))
        .when(kind < 5, wrap(_ZIP_HEAD, _DOCX_TAIL))
        .when(kind == 5, wrap(_ZIP_HEAD, _XLSX_TAIL))
        .when(kind == 6, wrap(_ZIP_HEAD, _OTHER_TAIL))
        .when(kind == 7, wrap(_ZIP_HEAD, b""))
        .otherwise(text)
    )
    return documents.select(
        F.concat(F.lit("file:/vol/"), "source", F.lit("/"), "doc_id", F.lit(".txt")).alias("path"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("modificationTime"),
        content.alias("content"),
    ).withColumn("length", F.length("content").cast("bigint"))


def _blob(data: bytes) -> str:
    return "'" + "".join(f"\\x{b:02X}" for b in data) + "'::BLOB"


FILES = f"""
files AS (
  SELECT path, modificationTime, content, CAST(octet_length(content) AS BIGINT) AS length FROM (
    SELECT 'file:/vol/' || source || '/' || doc_id || '.txt' AS path,
           TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS modificationTime,
           CASE WHEN length(text) % 10 < 2 THEN {_blob(_PDF_HEAD)} || encode(text) || {_blob(_PDF_TAIL)}
                WHEN length(text) % 10 = 2 THEN {_blob(_PDF_HEAD)} || encode(text)
                WHEN length(text) % 10 < 5 THEN {_blob(_ZIP_HEAD)} || encode(text) || {_blob(_DOCX_TAIL)}
                WHEN length(text) % 10 = 5 THEN {_blob(_ZIP_HEAD)} || encode(text) || {_blob(_XLSX_TAIL)}
                WHEN length(text) % 10 = 6 THEN {_blob(_ZIP_HEAD)} || encode(text) || {_blob(_OTHER_TAIL)}
                WHEN length(text) % 10 = 7 THEN {_blob(_ZIP_HEAD)} || encode(text)
                ELSE encode(text) END AS content
    FROM documents))
"""


def bronze_view(spark: SparkSession, folder: str, accept_text: bool = False) -> DataFrame:
    """Captured files; ingestion is one hour after modification."""
    return enrich(files_view(spark, folder), F.col("modificationTime") + F.expr("interval 1 hour"), accept_text)


def _hex(data: bytes) -> str:
    return f"'%{data.hex().upper()}%'"


BRONZE = f"""
bronze AS (
  SELECT content, path AS source_path, split_part(path, '/', -1) AS file_name, length AS file_size,
         modificationTime AS file_modification_time, modificationTime + INTERVAL 1 HOUR AS ingestion_timestamp,
         sha256(content) AS content_hash, split_part(path, '/', -2) AS source_classification_tag,
         CASE WHEN head = '25504446' THEN 'pdf'
              WHEN head <> '504B0304' THEN 'unknown'
              WHEN h NOT LIKE {_hex(b"PK\x05\x06")} THEN 'zip_based_unknown'
              WHEN h LIKE {_hex(b"word/document.xml")} THEN 'docx'
              WHEN h LIKE {_hex(b"xl/workbook.xml")} THEN 'xlsx'
              ELSE 'zip_based_unknown' END AS file_type,
         CASE WHEN length < 4 THEN 'empty_or_truncated'
              WHEN head = '25504446' AND h LIKE {_hex(b"startxref")} AND h LIKE {_hex(b"%%EOF")}
                   AND h LIKE {_hex(b"/Type /Page")} THEN 'valid'
              WHEN head = '25504446' THEN 'corrupt_pdf'
              WHEN head <> '504B0304' THEN 'unsupported_file_type'
              WHEN h NOT LIKE {_hex(b"PK\x05\x06")} THEN 'corrupt_zip'
              WHEN h LIKE {_hex(b"word/document.xml")} OR h LIKE {_hex(b"xl/workbook.xml")} THEN 'valid'
              ELSE 'unsupported_file_type' END AS processing_status
  FROM (SELECT *, hex(content) AS h, substr(hex(content), 1, 8) AS head FROM files))
"""


# --- typed: documents as already detected content, whose parts are its lines ----------------------


def typed_view(spark: SparkSession, folder: str) -> DataFrame:
    """Valid bronze rows with the plain text as content and a type by length."""
    kind = F.length("text") % 10
    return spread(table(spark, folder, "documents")).select(
        F.col("text").cast("binary").alias("content"),
        F.concat(F.lit("file:/vol/"), "source", F.lit("/"), "doc_id", F.lit(".txt")).alias("source_path"),
        F.concat("doc_id", F.lit(".txt")).alias("file_name"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("file_modification_time"),
        F.timestamp_seconds(F.lit(1704070800) + F.col("doc_id") * 60).alias("ingestion_timestamp"),
        content_hash(F.col("text").cast("binary")).alias("content_hash"),
        F.when(kind < 3, "pdf").when(kind < 5, "docx").when(kind < 8, "xlsx").otherwise("text").alias("file_type"),
        F.col("source").alias("source_classification_tag"),
        F.lit("valid").alias("processing_status"),
    )


TYPED = """
typed AS (
  SELECT doc_id, text, source, 'file:/vol/' || source || '/' || doc_id || '.txt' AS source_path,
         doc_id || '.txt' AS file_name, CAST(strlen(text) AS BIGINT) AS file_size,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS file_modification_time,
         TIMESTAMP '2024-01-01 01:00:00' + to_minutes(doc_id) AS ingestion_timestamp,
         sha256(text) AS content_hash,
         CASE WHEN length(text) % 10 < 3 THEN 'pdf' WHEN length(text) % 10 < 5 THEN 'docx'
              WHEN length(text) % 10 < 8 THEN 'xlsx' ELSE 'text' END AS file_type
  FROM documents)
"""

UNIQUE = """
uniq AS (
  SELECT t.* FROM typed t
  JOIN (SELECT content_hash, min(source_path) AS source_path FROM typed GROUP BY content_hash) w
    USING (content_hash, source_path))
"""

# Overrides whose prefixes must be anchored: src1/ may not catch src10 to src19.
EXTRACTION_CONFIG = {
    "extraction": {
        "defaults": {
            "pdf": "pymupdf_standard",
            "docx": "python_docx_standard",
            "xlsx": "openpyxl_standard",
            "text": "plain_text_decode",
        },
        "overrides": [
            {"path_prefix": "src1/", "file_type": "pdf", "method": "azure_document_intelligence_ocr"},
            {"path_prefix": "src1", "file_type": "pdf", "method": "pymupdf_standard"},
            {"path_prefix": "src2/", "file_type": "docx", "method": "custom_reader", "on_failure": "partial"},
            {"path_prefix": "rc3/", "file_type": "pdf", "method": "custom_reader"},
        ],
    }
}

DECIDED = """
decided AS (
  SELECT *, CASE WHEN file_type = 'pdf' AND contains(source_path, '/src1/') THEN 'azure_document_intelligence_ocr'
                 WHEN file_type = 'docx' AND contains(source_path, '/src2/') THEN 'custom_reader'
                 WHEN file_type = 'pdf' THEN 'pymupdf_standard' WHEN file_type = 'docx' THEN 'python_docx_standard'
                 WHEN file_type = 'xlsx' THEN 'openpyxl_standard' ELSE 'plain_text_decode' END AS method
  FROM uniq)
"""


def line_parts(method, content):
    """Parts of a text: its lines as pages, paragraphs (short lines are headings) or sheet rows."""
    lines = F.split(content.cast("string"), "\n", -1)
    paragraphs = F.transform(lines, lambda l: F.struct(l.alias("text"), (F.length(l) < 60).alias("is_heading")))
    rows = F.transform(lines, lambda l: F.split(l, ", ", -1))
    return F.when(
        content.isNotNull(),
        F.struct(
            F.lit(None).cast("string").alias("error"),
            F.when(method == "pymupdf_standard", lines).alias("pages"),
            F.when(method == "azure_document_intelligence_ocr", F.array(lines)).alias("ocr_pages"),
            F.when(method == "python_docx_standard", paragraphs).alias("paragraphs"),
            F.when(
                method == "openpyxl_standard", F.array(F.struct(F.lit("Sheet1").alias("title"), rows.alias("rows")))
            ).alias("sheets"),
        ),
    )


def extracted_view(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.lifecycle import one_per_content

    return extract(one_per_content(typed_view(spark, folder)), line_parts, EXTRACTION_CONFIG)


SECTIONS = f"""
lines AS (
  SELECT content_hash, method, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS line
  FROM (SELECT content_hash, method, string_split(text, chr(10)) AS parts FROM decided)),
paras AS (
  SELECT content_hash, pos, {sql_strip("line")} AS t, length(line) < 60 AS h FROM lines
  WHERE method = 'python_docx_standard' AND {sql_strip("line")} <> ''),
grouped AS (
  SELECT *, sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY content_hash ORDER BY pos) AS g FROM paras),
bodies AS (
  SELECT content_hash, g, string_agg(t, chr(10) ORDER BY pos) AS t FROM grouped WHERE NOT h GROUP BY content_hash, g),
head_sections AS (
  SELECT b.content_hash, row_number() OVER (PARTITION BY b.content_hash ORDER BY b.g) - 1 AS position, g.t AS heading, b.t AS t
  FROM bodies b LEFT JOIN grouped g ON g.content_hash = b.content_hash AND g.g = b.g AND g.h),
cells AS (
  SELECT content_hash, pos, generate_subscripts(parts, 1) AS i, unnest(parts) AS v
  FROM (SELECT content_hash, pos, string_split(line, ', ') AS parts FROM lines WHERE method = 'openpyxl_standard')),
labelled AS (
  SELECT c.content_hash, c.pos, string_agg(h.v || ': ' || c.v, ', ' ORDER BY c.i) AS t
  FROM cells c JOIN cells h ON h.content_hash = c.content_hash AND h.pos = 0 AND h.i = c.i
  WHERE c.pos > 0 AND c.v <> '' GROUP BY c.content_hash, c.pos),
sections AS (
  SELECT content_hash, CAST(pos AS BIGINT) AS position, NULL AS heading, {sql_strip("line")} AS t FROM lines WHERE method = 'pymupdf_standard'
  UNION ALL SELECT content_hash, 0, NULL, text FROM decided WHERE method = 'azure_document_intelligence_ocr'
  UNION ALL SELECT content_hash, position, heading, t FROM head_sections
  UNION ALL SELECT content_hash, row_number() OVER (PARTITION BY content_hash ORDER BY pos) - 1, 'Sheet1', t FROM labelled
  UNION ALL SELECT content_hash, 0, NULL, {sql_strip("text")} FROM decided
            WHERE method = 'plain_text_decode' AND {sql_strip("text")} <> ''),
full_texts AS (
  SELECT content_hash, {sql_strip("string_agg(t, chr(10) || chr(10) ORDER BY position)")} AS full_text FROM sections
  WHERE content_hash NOT IN (SELECT content_hash FROM decided WHERE method IN ('python_docx_standard', 'openpyxl_standard'))
  GROUP BY content_hash
  UNION ALL SELECT content_hash, string_agg(t, chr(10) || chr(10) ORDER BY pos) FROM paras GROUP BY content_hash
  UNION ALL SELECT content_hash, {sql_strip("string_agg(t, chr(10) ORDER BY pos)")} FROM labelled GROUP BY content_hash),
extracted AS (
  SELECT d.content_hash, d.file_type, d.method AS extraction_method_used,
         CASE WHEN d.method = 'custom_reader' THEN 'no_extraction_rule_matched'
              WHEN coalesce(f.full_text, '') = '' THEN 'empty' ELSE 'success' END AS extraction_status,
         coalesce(f.full_text, '') AS full_text,
         CASE WHEN d.method = 'custom_reader' THEN 'Unknown method: custom_reader' END AS error_message
  FROM decided d LEFT JOIN full_texts f USING (content_hash))
"""

EXTRACTED = ",\n".join(c.strip() for c in (TYPED, UNIQUE, DECIDED, SECTIONS))


def sql_windows(source: str, keys: str, text: str, size: int = SIZE, overlap: int = OVERLAP) -> str:
    """Overlapping windows of a text column: ``keys, w, piece``."""
    window, step = size * 4, (size - overlap) * 4
    return f"""
      SELECT {keys}, w, CASE WHEN length({text}) <= {window} THEN {text}
                             ELSE substring({text}, w * {step} + 1, {window}) END AS piece
      FROM (SELECT *, unnest(range(CASE WHEN length({text}) <= {window} THEN 1
                                   ELSE CAST(ceil(length({text}) / {float(step)}) AS BIGINT) END)) AS w
            FROM {source})"""


def chunks_view(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed-window chunks of each distinct text."""
    from ..operators.lifecycle import one_per_content

    unique = one_per_content(typed_view(spark, folder))
    pieces = fixed_chunks(text_sections(F.col("content").cast("string")), SIZE, OVERLAP)
    return chunk_rows(
        unique.select(
            "content_hash",
            F.lit("fixed_size_with_overlap").alias("chunking_method_used"),
            F.lit("plain_text_decode").alias("extraction_method_used"),
            pieces.alias("_pieces"),
        )
    )


CHUNKS = f"""
chunks AS (
  SELECT sha256(content_hash || '_' || w) AS chunk_id, content_hash, CAST(w AS INTEGER) AS chunk_index, piece AS chunk_text,
         {sql_approx_tokens("piece")} AS token_count
  FROM ({sql_windows("(SELECT content_hash, text FROM uniq)", "content_hash", "text")}))
"""

FIXED_CHUNKS = ",\n".join(c.strip() for c in (TYPED, UNIQUE, CHUNKS))


def dispatched_view(spark: SparkSession, folder: str) -> DataFrame:
    return chunk(extracted_view(spark, folder))


# --- instances and access -----------------------------------------------------------------------


def acl_map(spark: SparkSession, folder: str) -> DataFrame:
    """Source tag to region, leaving the tags of the last region unmapped."""
    tags = table(spark, folder, "documents").select("source").distinct()
    regions = table(spark, folder, "region").filter("r_regionkey < 4")
    number = (F.regexp_extract("source", r"(\d+)", 1).cast("int") % 5).alias("r_regionkey")
    return tags.select(F.col("source").alias("tag"), number).join(regions, "r_regionkey").select(
        "tag", F.col("r_name").alias("acl_group"), F.col("r_regionkey").alias("restrictiveness")
    )


ACL_MAP = """
acl_map AS (
  SELECT source AS tag, r_name AS acl_group, r_regionkey AS restrictiveness
  FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) % 5 AS k FROM documents)
  JOIN region ON r_regionkey = k AND r_regionkey < 4)
"""


def instances_view(spark: SparkSession, folder: str) -> DataFrame:
    """One active instance per document with its access group."""
    from ..operators.gold import resolve_acl
    from ..operators.lifecycle import instances

    bronze = typed_view(spark, folder)
    rows = instances(bronze).withColumn(
        "source_classification_tag", F.element_at(F.split("source_path", "/"), -2)
    )
    return resolve_acl(rows, acl_map(spark, folder))


INSTANCES = """
instances AS (
  SELECT source_path, file_name, content_hash, ingestion_timestamp, file_type, source AS tag,
         acl_group AS resolved_acl_group, restrictiveness
  FROM typed LEFT JOIN acl_map ON tag = source)
"""


def live_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files still present: those whose document is labelled."""
    documents = table(spark, folder, "documents")
    labelled = documents.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return labelled.select(
        F.concat(F.lit("file:/vol/"), "source", F.lit("/"), "doc_id", F.lit(".txt")).alias("path"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("modificationTime"),
    )


LIVE = """
live AS (
  SELECT 'file:/vol/' || source || '/' || doc_id || '.txt' AS path, CAST(strlen(text) AS BIGINT) AS length,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS modificationTime
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
"""
