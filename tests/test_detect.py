"""Type detection on real containers and damaged ones."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from parchline.functions.detect import detect, with_plain_text


def box(*names: str, comment: bytes = b"", method=zipfile.ZIP_DEFLATED) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name in names:
            z.writestr(name, "x" * 100)
        z.comment = comment
    return out.getvalue()


PDF = b"%PDF-1.4\n1 0 obj<</Type /Page>>endobj\nxref\nstartxref\n9\n%%EOF"
CASES = {
    "null": (None, "unknown", "empty_or_truncated"),
    "empty": (b"", "unknown", "empty_or_truncated"),
    "three": (b"%PD", "unknown", "empty_or_truncated"),
    "pdf": (PDF, "pdf", "valid"),
    "pdf_streams": (b"%PDF-1.5\n<</Type /ObjStm>>\nstartxref\n9\n%%EOF", "pdf", "valid"),
    "pdf_cut": (PDF[:40], "pdf", "corrupt_pdf"),
    "pdf_no_page": (b"%PDF-1.4\n<</Type /Pages>>\nstartxref\n9\n%%EOF", "pdf", "corrupt_pdf"),
    "docx": (box("[Content_Types].xml", "word/document.xml"), "docx", "valid"),
    "xlsx": (box("xl/workbook.xml", "xl/worksheets/sheet1.xml"), "xlsx", "valid"),
    "both": (box("xl/workbook.xml", "word/document.xml"), "docx", "valid"),
    "comment": (box("word/document.xml", comment=b"a comment PK\x05 of some length"), "docx", "valid"),
    "other": (box("readme.txt"), "zip_based_unknown", "unsupported_file_type"),
    "longer_name": (box("word/document.xml.rels", "xword/document.xml"), "zip_based_unknown", "unsupported_file_type"),
    "nested": (
        box("inner.bin", method=zipfile.ZIP_STORED).replace(b"x" * 17, b"word/document.xml", 1),
        "zip_based_unknown",
        "unsupported_file_type",
    ),
    "cut_zip": (box("word/document.xml")[:-30], "zip_based_unknown", "corrupt_zip"),
    "zip_head_only": (b"PK\x03\x04", "zip_based_unknown", "corrupt_zip"),
    "bad_directory": (b"PK\x03\x04" + b"PK\x05\x06" + b"\xff" * 18, "zip_based_unknown", "corrupt_zip"),
    "text": (b"plain text", "unknown", "unsupported_file_type"),
}


def run(spark, expression):
    rows = [(name, content) for name, (content, _, _) in CASES.items()]
    frame = spark.createDataFrame(rows, "name string, content binary")
    found = frame.select("name", expression(F.col("content")).alias("d")).select("name", "d.*").collect()
    return {r["name"]: (r["file_type"], r["processing_status"]) for r in found}


def test_strict(spark):
    assert run(spark, detect) == {name: case[1:] for name, case in CASES.items()}


def test_real_zip_reader_agrees(spark):
    """Whatever the standard zip reader can open is not called corrupt, and the reverse."""
    found = run(spark, detect)
    for name, (content, _, _) in CASES.items():
        if content and content[:4] == b"PK\x03\x04":
            try:
                zipfile.ZipFile(io.BytesIO(content)).namelist()
                readable = True
            except zipfile.BadZipFile:
                readable = False
            assert (found[name][1] != "corrupt_zip") == readable, name


def test_text_is_opt_in(spark):
    found = run(spark, lambda c: with_plain_text(detect(c), c))
    assert found["text"] == ("text", "valid")
    assert found["pdf"] == ("pdf", "valid") and found["empty"] == ("unknown", "empty_or_truncated")


@pytest.mark.parametrize("junk", [b"\xff\xfe binary", b"nul \x00 byte"])
def test_binary_is_not_text(spark, junk):
    frame = spark.createDataFrame([(junk,)], "content binary")
    kind = frame.select(with_plain_text(detect(F.col("content")), F.col("content")).alias("d")).first()["d"]
    assert kind["file_type"] == "unknown"
