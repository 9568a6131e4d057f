"""Sections: the common shape every extraction method produces.

Two forms of each method. The *row* form turns nested parts of one file (which fit a cell, since
the file did) into an ``array<struct<heading, text, position>>`` without any shuffle. The *table*
form takes one row per page, paragraph or line and never gathers a whole document.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import bind
from ..functions.text import is_blank, strip
from .ordered import concat_ordered, running
from .rules import EXTRACTION_RULES, extraction_decision

SECTIONS_TYPE = "array<struct<heading:string,text:string,position:int>>"
PARTS_TYPE = (
    "struct<error:string,pages:array<string>,ocr_pages:array<array<string>>,"
    "paragraphs:array<struct<text:string,is_heading:boolean>>,"
    "sheets:array<struct<title:string,rows:array<array<string>>>>>"
)


def _section(heading: Column, text: Column, position: Column) -> Column:
    return F.struct(
        heading.cast("string").alias("heading"), text.alias("text"), position.cast("int").alias("position")
    )


def _no_sections() -> Column:
    return F.array().cast(SECTIONS_TYPE)


def _positions(pairs: Column) -> Column:
    return F.transform(pairs, lambda p, i: _section(p["heading"], p["text"], i))


# --- row form -----------------------------------------------------------------------------------


def page_sections(pages: Column) -> Column:
    """One section per page, trimmed; blank pages stay as empty sections."""
    return F.transform(pages, lambda p, i: _section(F.lit(None), strip(p), i))


def line_page_sections(pages: Column) -> Column:
    """Pages given as lines: joined by line breaks, not trimmed per page."""
    return F.transform(pages, lambda p, i: _section(F.lit(None), F.array_join(p, "\n"), i))


def _kept_paragraphs(paragraphs: Column) -> Column:
    trimmed = F.transform(
        paragraphs,
        lambda p: F.struct(strip(p["text"]).alias("text"), F.coalesce(p["is_heading"], F.lit(False)).alias("is_heading")),
    )
    return F.filter(trimmed, lambda p: p["text"] != "")


def heading_sections(paragraphs: Column) -> Column:
    """Paragraphs grouped under the latest heading; a heading without body yields nothing."""

    def group(kept: Column, headings: Column) -> Column:
        # A section runs from its heading (or the start, 0) to the next heading or the end.
        starts = F.concat(F.array(F.lit(0)), headings)
        ends = F.concat(headings, F.array(F.size(kept) + 1))
        return F.zip_with(
            starts,
            ends,
            lambda start, end: F.struct(
                F.when(start > 0, F.get(kept, start - 1)["text"]).alias("heading"),
                F.array_join(
                    F.transform(F.slice(kept, start + 1, end - start - 1), lambda p: p["text"]), "\n"
                ).alias("text"),
            ),
        )

    def of_kept(kept: Column) -> Column:
        places = F.transform(kept, lambda p, i: F.when(p["is_heading"], i + 1))
        return bind(F.filter(places, lambda i: i.isNotNull()), lambda headings: group(kept, headings))

    groups = bind(_kept_paragraphs(paragraphs), of_kept)
    return _positions(F.filter(groups, lambda g: g["text"] != ""))


def row_sections(sheets: Column) -> Column:
    """One section per data row, values labelled by the sheet's first row, blanks left out."""

    def labelled(header: Column, row: Column) -> Column:
        pairs = F.zip_with(
            header,
            row,
            lambda h, v: F.when(h.isNotNull() & (v != ""), F.concat(h, F.lit(": "), v)),
        )
        return F.array_join(pairs, ", ")

    def blanks(cells: Column) -> Column:
        return F.transform(cells, lambda c: F.coalesce(c, F.lit("")))

    def of_rows(title: Column, rows: Column) -> Column:
        return F.transform(
            F.slice(rows, F.lit(2), F.greatest(F.size(rows), F.lit(1))),
            lambda row: F.struct(title.alias("heading"), labelled(F.get(rows, F.lit(0)), row).alias("text")),
        )

    def of_sheet(sheet: Column) -> Column:
        return bind(F.transform(sheet["rows"], blanks), lambda rows: of_rows(sheet["title"], rows))

    return _positions(F.filter(F.flatten(F.transform(sheets, of_sheet)), lambda s: s["text"] != ""))


def text_sections(text: Column) -> Column:
    return F.when(text == "", _no_sections()).otherwise(
        F.array(_section(F.lit(None), text, F.lit(0)))
    )


def _texts(sections: Column) -> Column:
    return F.transform(sections, lambda s: s["text"])


def _result(status: Column, full_text: Column, sections: Column, error: Column) -> Column:
    return F.struct(
        status.alias("status"),
        full_text.alias("full_text"),
        F.coalesce(sections, _no_sections()).alias("sections"),
        error.cast("string").alias("error"),
    )


def _assembled(sections: Column, full_text: Column, error: Column) -> Column:
    def filled(text: Column) -> Column:
        status = F.when(text == "", F.lit("empty")).otherwise(F.lit("success"))
        return _result(status, F.coalesce(text, F.lit("")), sections, F.lit(None))

    corrupt = _result(F.lit("corrupt"), F.lit(""), _no_sections(), error)
    return F.when(error.isNotNull(), corrupt).otherwise(bind(full_text, filled))


def decode_text(content: Column) -> Column:
    """UTF-8 content to ``struct<status, full_text, sections, error>``."""
    text = content.cast("string")
    error = F.when(~F.is_valid_utf8(text), F.lit("content is not valid UTF-8"))
    return bind(F.when(F.is_valid_utf8(text), strip(text)), lambda t: _assembled(text_sections(t), t, error))


def method_result(method: str, parts: Column, content: Column) -> Column:
    """What one extraction method makes of a file's parts."""
    error = parts["error"]

    def joined(separator: str):
        return lambda sections: _assembled(sections, strip(F.array_join(_texts(sections), separator)), error)

    if method == "pymupdf_standard":
        return bind(page_sections(parts["pages"]), joined("\n\n"))
    if method == "azure_document_intelligence_ocr":
        return bind(line_page_sections(parts["ocr_pages"]), joined("\n\n"))
    if method == "openpyxl_standard":
        return bind(row_sections(parts["sheets"]), joined("\n"))
    if method == "python_docx_standard":
        full_text = F.array_join(_texts(_kept_paragraphs(parts["paragraphs"])), "\n\n")
        return _assembled(heading_sections(parts["paragraphs"]), full_text, error)
    if method == "plain_text_decode":
        return decode_text(content)
    raise ValueError(f"no such extraction method: {method}")


# Methods that need a file's inner parts; a plain decode does not.
PART_METHODS = (
    "pymupdf_standard",
    "python_docx_standard",
    "openpyxl_standard",
    "azure_document_intelligence_ocr",
)


def extract(
    documents: DataFrame,
    parts_reader,
    config: dict[str, Any] = EXTRACTION_RULES,
    methods: tuple[str, ...] = (*PART_METHODS, "plain_text_decode"),
) -> DataFrame:
    """Resolve each document's method and apply it, all in one scan.

    ``parts_reader(method, content)`` is a column expression giving ``PARTS_TYPE``; it gets NULL
    content for rows whose method needs no parts, so their bytes are not shipped anywhere.
    """
    decided = documents.withColumn(
        "_decision", extraction_decision(F.col("source_path"), F.col("file_type"), config)
    )
    method = F.col("_decision.method")
    wanted = [m for m in methods if m in PART_METHODS]
    parts = decided.withColumn(
        "_parts", parts_reader(method, F.when(method.isin(wanted), F.col("content"))).cast(PARTS_TYPE)
    )
    unknown = _result(
        F.lit("no_extraction_rule_matched"),
        F.lit(""),
        _no_sections(),
        F.when(method.isNotNull(), F.concat(F.lit("Unknown method: "), method)),
    )
    outcome = unknown
    for name in methods:
        outcome = F.when(method == name, method_result(name, F.col("_parts"), F.col("content"))).otherwise(outcome)
    return parts.withColumn("_out", outcome).select(
        "content_hash",
        "file_type",
        method.alias("extraction_method_used"),
        F.col("_out.status").alias("extraction_status"),
        F.col("_out.full_text").alias("full_text"),
        F.col("_out.sections").alias("sections"),
        F.col("_out.error").alias("error_message"),
    )


# --- table form ---------------------------------------------------------------------------------


def page_table(parts: DataFrame, doc: str, position: str, text: str) -> DataFrame:
    """One section per page row: a projection."""
    return parts.select(
        doc, F.col(position).cast("int").alias("position"), F.lit(None).cast("string").alias("heading"),
        strip(F.col(text)).alias("text"),
    )


def document_status(sections: DataFrame, doc: str) -> DataFrame:
    """``success`` or ``empty`` per document, from partial aggregates only."""
    return sections.groupBy(doc).agg(
        F.count("*").alias("n_sections"),
        F.when(F.bool_or(~is_blank(F.col("text"))), "success").otherwise("empty").alias("extraction_status"),
    )


def full_text_table(sections: DataFrame, doc: str, separator: str = "\n\n") -> DataFrame:
    """The document text in order, as ``doc, part_no, full_text``."""
    return concat_ordered(sections, [doc], "position", "text", separator).withColumnRenamed("text", "full_text")


def line_page_table(lines: DataFrame, keys: list[str], line_no: str, text: str) -> DataFrame:
    """Lines joined to pages by line breaks, untrimmed: ``keys, part_no, text``."""
    return concat_ordered(lines, keys, line_no, text, "\n")


def heading_table(paragraphs: DataFrame, doc: str, position: str, text: str, is_heading: Column) -> DataFrame:
    """Heading sections over paragraph rows: ``doc, position, heading, part_no, text``.

    The latest heading is carried across blocks, so a document of any size is handled.
    """
    kept = (
        paragraphs.select(
            doc,
            F.col(position).cast("long").alias("_pos"),
            strip(F.col(text)).alias("text"),
            F.coalesce(is_heading, F.lit(False)).alias("_heading"),
        )
        .filter(F.col("text") != "")
    )
    marked = running(
        kept,
        [doc],
        "_pos",
        lasts={"_head": F.when(F.col("_heading"), F.struct(F.col("_pos").alias("at"), F.col("text").alias("text")))},
    )
    bodies = marked.filter(~F.col("_heading")).select(
        doc,
        F.coalesce(F.col("_head.at"), F.lit(-1)).alias("_start"),
        F.col("_head.text").alias("heading"),
        "_pos",
        "text",
    )
    joined = concat_ordered(bodies.drop("heading"), [doc, "_start"], "_pos", "text", "\n")
    # A section is numbered by how many sections start before it.
    starts = bodies.groupBy(doc, "_start").agg(F.max("heading").alias("heading"))
    numbered = running(
        starts.withColumn("_order", F.col("_start") + 1), [doc], "_order", sums={"position": F.lit(1)}
    )
    return joined.join(numbered, [doc, "_start"]).select(
        doc, F.col("position").cast("int").alias("position"), "heading", "part_no", "text"
    )


def row_table(table: DataFrame, title: str, order: str, columns: list[str]) -> DataFrame:
    """Any table as labelled row texts: ``position, heading, text``.

    The rows come numbered by ``order`` (unique); blank rows are skipped, so positions are counted
    by a blockwise running sum rather than one global window.
    """
    pairs = [F.when(F.col(c).cast("string") != "", F.concat(F.lit(c + ": "), F.col(c).cast("string"))) for c in columns]
    rows = table.select(
        F.lit(title).alias("heading"), F.col(order).cast("long").alias("_order"), F.concat_ws(", ", *pairs).alias("text")
    ).filter(F.col("text") != "")
    return running(rows, ["heading"], "_order", sums={"position": F.lit(1)}).select(
        F.col("position").cast("int").alias("position"), "heading", "text"
    )


def apply_failure_policy(parts: DataFrame, doc: str, bad: Column, policy: Column) -> DataFrame:
    """``atomic``: one bad part drops the whole document. ``partial``: only bad parts go.

    Documents with bad parts are found first (a partial aggregate, one row per such document) and
    removed by an anti join, so no document is gathered.
    """
    marked = parts.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn("_policy", policy)
    failed = marked.filter(F.col("_bad") & (F.col("_policy") != "partial")).select(doc).distinct()
    dented = marked.filter(F.col("_bad") & (F.col("_policy") == "partial")).select(doc).distinct()
    good = marked.filter(~F.col("_bad")).join(failed, doc, "left_anti")
    return good.join(dented.withColumn("_dented", F.lit(True)), doc, "left").select(
        *parts.columns, F.col("_policy").alias("on_failure"), F.coalesce("_dented", F.lit(False)).alias("is_partial")
    )
