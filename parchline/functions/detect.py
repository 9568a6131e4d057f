"""File type and integrity from content bytes, without leaving the JVM.

The extension is never looked at. Zip containers are recognised the way zip readers do it: the
end record in the file's tail says how long the member list before it is, and only that list is
searched for the member name.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .binding import bind

# Signatures and member names that decide the type.
PDF_MAGIC = b"%PDF"
ZIP_MAGIC = b"PK\x03\x04"
DOCX_MEMBER = "word/document.xml"
XLSX_MEMBER = "xl/workbook.xml"

# Zip layout: the end record is 22 bytes plus a comment of at most 65535.
_END_MARK = "PK\x05\x06"
_END_SIZE = 22
_TAIL = 65535 + _END_SIZE


def _latin1(content: Column) -> Column:
    # Bytes as characters one to one, so positions in the string are byte positions.
    return F.call_function("decode", content, F.lit("ISO-8859-1"))


def _little_endian(text: Column, start: int, width: int) -> Column:
    parts = [F.ascii(F.substring(text, start + i, 1)).cast("long") * F.lit(256**i) for i in range(width)]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def _member_list(content: Column) -> Column:
    """The zip member list as latin-1 text; NULL where the container cannot be read."""

    def from_record(record: Column) -> Column:
        size = _little_endian(record, 13, 4)
        start = F.length(content) - F.length(record) - size
        members = _latin1(F.substring(content, (start + 1).cast("int"), size.cast("int")))
        whole = (F.length(record) >= _END_SIZE) & (start >= 0)
        return F.when(whole, members)

    def from_tail(tail: Column) -> Column:
        # The last end mark, looked for backwards; from there to the end of the file.
        to_mark = F.instr(F.reverse(tail), _END_MARK[::-1])
        return F.when(to_mark > 0, bind(F.right(tail, to_mark + F.lit(len(_END_MARK) - 1)), from_record))

    members = bind(_latin1(F.substring(content, -_TAIL, _TAIL)), from_tail)
    return bind(members, lambda m: F.when((m == "") | F.startswith(m, F.lit("PK\x01\x02")), m))


def _has_member(members: Column, name: str) -> Column:
    # A member entry: 28 fixed bytes (mark included), the name length, 16 more bytes, the name.
    length = f"\\x{len(name) & 255:02x}\\x{len(name) >> 8:02x}"
    entry = rf"(?s)PK\x01\x02.{{24}}{length}.{{16}}\Q{name}\E"
    return F.contains(members, F.lit(name)) & F.rlike(members, F.lit(entry))



def pdf_is_sound(content: Column) -> Column:
    """Structural check: a cross-reference pointer, an end mark and at least one page.

    Pages may sit in compressed object streams, which count as pages too.
    """
    return (
        F.contains(content, F.lit(b"startxref"))
        & F.contains(content, F.lit(b"%%EOF"))
        & (
            F.contains(content, F.lit(b"/ObjStm"))
            | F.rlike(_latin1(content), F.lit(r"/Type\s*/Page(?![A-Za-z])"))
        )
    )


def detect(content: Column) -> Column:
    """``struct<file_type, processing_status>`` of one file."""

    def verdict(file_type: str, status: str | Column) -> Column:
        status = F.lit(status) if isinstance(status, str) else status
        return F.struct(F.lit(file_type).alias("file_type"), status.alias("processing_status"))

    def container(members: Column) -> Column:
        return (
            F.when(members.isNull(), verdict("zip_based_unknown", "corrupt_zip"))
            .when(_has_member(members, DOCX_MEMBER), verdict("docx", "valid"))
            .when(_has_member(members, XLSX_MEMBER), verdict("xlsx", "valid"))
            .otherwise(verdict("zip_based_unknown", "unsupported_file_type"))
        )

    return (
        F.when(content.isNull() | (F.length(content) < 4), verdict("unknown", "empty_or_truncated"))
        .when(
            F.startswith(content, F.lit(PDF_MAGIC)),
            verdict("pdf", F.when(pdf_is_sound(content), "valid").otherwise("corrupt_pdf")),
        )
        .when(F.startswith(content, F.lit(ZIP_MAGIC)), bind(_member_list(content), container))
        .otherwise(verdict("unknown", "unsupported_file_type"))
    )


def with_plain_text(found: Column, content: Column) -> Column:
    """Opt-in: call unrecognised but valid UTF-8 content without NUL bytes ``text``.

    The strict detection above never yields ``text`` although the rule tables know it.
    """
    is_text = (
        (found["file_type"] == "unknown")
        & (found["processing_status"] == "unsupported_file_type")
        & F.is_valid_utf8(content.cast("string"))
        & ~F.contains(content, F.lit(b"\x00"))
    )
    return F.when(
        is_text, F.struct(F.lit("text").alias("file_type"), F.lit("valid").alias("processing_status"))
    ).otherwise(found)
