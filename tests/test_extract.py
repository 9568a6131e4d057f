"""Capture and extraction of office files, and the row form of each method."""

import io
import zipfile

from pyspark.sql import functions as F

from parchline.operators.capture import enrich
from parchline.operators.chunks import chunk
from parchline.operators.sections import extract, heading_sections, row_sections
from parchline.plans.views import line_parts

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def zipped(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def docx(paragraphs: list[tuple[str | None, str]]) -> bytes:
    body = "".join(
        f'<w:p><w:pPr>{f"<w:pStyle w:val={chr(34)}{style}{chr(34)}/>" if style else ""}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'
        for style, text in paragraphs
    )
    styles = f'<w:styles xmlns:w="{W}"><w:style w:styleId="H1"><w:name w:val="heading 1"/></w:style></w:styles>'
    return zipped(
        {"word/document.xml": f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>', "word/styles.xml": styles}
    )


def xlsx(rows: list[list[str]], title: str = "Prices") -> bytes:
    cells = "".join(
        f'<row r="{r}">' + "".join(f'<c r="{"ABC"[c]}{r}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in enumerate(row) if v) + "</row>"
        for r, row in enumerate(rows, 1)
    )
    return zipped(
        {
            "xl/workbook.xml": f'<workbook xmlns="{S}" xmlns:r="{R}"><sheets><sheet name="{title}" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{S}"><sheetData>{cells}</sheetData></worksheet>',
        }
    )


def opened(method, content):
    """What a reader of office files would give for the files below."""
    line = lambda text, heading: F.struct(F.lit(text).alias("text"), F.lit(heading).alias("is_heading"))
    paragraphs = F.array(line("intro", False), line("Title", True), line("body one", False), line("body two", False))
    rows = F.array(*[F.array(*map(F.lit, r)) for r in (["id", "name"], ["1", "ring"], ["", ""], ["2", ""])])
    sheets = F.array(F.struct(F.lit("Prices").alias("title"), rows.alias("rows")))
    return F.when(
        content.isNotNull(),
        F.struct(
            F.when(F.length(content) < 250, "not readable").alias("error"),
            F.lit(None).cast("array<string>").alias("pages"),
            F.lit(None).cast("array<array<string>>").alias("ocr_pages"),
            F.when(method == "python_docx_standard", paragraphs).alias("paragraphs"),
            F.when(method == "openpyxl_standard", sheets).alias("sheets"),
        ),
    )


def test_office_files_end_to_end(spark, tmp_path):
    (tmp_path / "team").mkdir()
    (tmp_path / "team" / "a.bin").write_bytes(docx([(None, "intro"), ("H1", "Title"), (None, "body one"), (None, "body two")]))
    (tmp_path / "team" / "b.bin").write_bytes(xlsx([["id", "name"], ["1", "ring"], ["", ""], ["2", ""]]))
    (tmp_path / "team" / "c.bin").write_bytes("  free text ".encode())
    (tmp_path / "team" / "d.bin").write_bytes(zipped({"word/document.xml": "<broken"}))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    bronze = enrich(files, accept_text=True)
    assert {r[0] for r in bronze.select("source_classification_tag").collect()} == {"team"}
    rows = {r["file_type"] + r["extraction_status"]: r for r in extract(bronze, opened).collect()}
    assert set(rows) == {"docxsuccess", "docxcorrupt", "xlsxsuccess", "textsuccess"}
    assert [(s["heading"], s["text"], s["position"]) for s in rows["docxsuccess"]["sections"]] == [
        (None, "intro", 0),
        ("Title", "body one\nbody two", 1),
    ]
    assert rows["docxsuccess"]["full_text"] == "intro\n\nTitle\n\nbody one\n\nbody two"
    assert [(s["heading"], s["text"]) for s in rows["xlsxsuccess"]["sections"]] == [
        ("Prices", "id: 1, name: ring"),
        ("Prices", "id: 2"),
    ]
    assert rows["textsuccess"]["full_text"] == "free text"
    assert "not readable" in rows["docxcorrupt"]["error_message"]
    chunks = chunk(extract(bronze, opened)).collect()
    assert sorted(c["chunk_text"] for c in chunks) == sorted(
        ["intro", "body one\nbody two", "id: 1, name: ring", "id: 2", "free text"]
    )


def test_decode_branches(spark):
    rows = [("ok", b" a\xc2\xa0"), ("blank", b" \n"), ("bad", b"\xff\x41")]
    frame = spark.createDataFrame(rows, "content_hash string, content binary").select(
        "*", F.lit("/x/a").alias("source_path"), F.lit("text").alias("file_type")
    )
    found = {r["content_hash"]: r for r in extract(frame, line_parts).collect()}
    assert (found["ok"]["extraction_status"], found["ok"]["full_text"]) == ("success", "a")
    assert (found["blank"]["extraction_status"], found["blank"]["sections"]) == ("empty", [])
    assert found["bad"]["extraction_status"] == "corrupt" and found["bad"]["error_message"]


def test_row_form(spark):
    frame = spark.createDataFrame(
        [([("h", True), ("g", True), (" x ", False), ("", False), ("last", True)],)],
        "p array<struct<text:string,is_heading:boolean>>",
    )
    (row,) = frame.select(heading_sections(F.col("p")).alias("s")).collect()
    assert [tuple(s) for s in row["s"]] == [("g", "x", 0)]
    sheets = spark.createDataFrame(
        [([("s", [["a", None, "c"], ["1", "2"], [], ["", "", "", "9"], ["", "", "3"]]), ("empty", [])],)],
        "t array<struct<title:string,rows:array<array<string>>>>",
    )
    (row,) = sheets.select(row_sections(F.col("t")).alias("s")).collect()
    assert [tuple(s) for s in row["s"]] == [("s", "a: 1, : 2", 0), ("s", "c: 3", 1)]
