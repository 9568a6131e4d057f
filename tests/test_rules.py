import pytest

from parchline.operators.rules import (
    CHUNKING_RULES,
    EXTRACTION_RULES,
    check_chunking,
    load_rules,
    resolve_chunking,
    resolve_extraction,
    resolve_retrieval,
)


def test_extraction_rules(spark):
    config = {
        "extraction": {
            "defaults": {"pdf": "standard"},
            "overrides": [
                {"path_prefix": "scans/", "file_type": "pdf", "method": "first"},
                {"path_prefix": "scans", "file_type": "pdf", "method": "second", "on_failure": "partial"},
                {"file_type": "docx", "method": "anywhere"},
            ],
        }
    }
    cases = {
        "file:/v/scans/a.pdf": ("pdf", "first", "override"),
        "file:/v/my_scans/a.pdf": ("pdf", "standard", "default"),
        "file:/v/scans_old/a.pdf": ("pdf", "standard", "default"),
        "file:/v/scans/a.docx": ("docx", "anywhere", "override"),
        "abfss://v/a.docx": ("docx", "anywhere", "override"),
        "file:/v/x.bin": ("unknown", None, "none"),
    }
    frame = spark.createDataFrame([(p, t) for p, (t, _, _) in cases.items()], "source_path string, file_type string")
    found = {r["source_path"]: r for r in resolve_extraction(frame, config).collect()}
    for path, (_, method, matched) in cases.items():
        assert (found[path]["extraction_method"], found[path]["matched_rule"]) == (method, matched), path
    assert found["file:/v/scans/a.pdf"]["on_failure"] == "atomic"


def test_chunking_rules(spark):
    frame = spark.createDataFrame(
        [("pdf", "azure_document_intelligence_ocr"), ("pdf", "pymupdf_standard"), ("xlsx", None), ("odd", None)],
        "file_type string, extraction_method_used string",
    )
    found = [(r["chunking_method"], r["chunk_size"], r["overlap"], r["matched_rule"]) for r in resolve_chunking(frame).collect()]
    assert found == [
        ("semantic_split", 256, 25, "override"),
        ("recursive_structure_aware", 512, 50, "default"),
        ("table_aware_row_based", None, None, "default"),
        (None, None, None, "none"),
    ]


def test_retrieval_overrides_field_by_field(spark):
    frame = spark.createDataFrame([("quick-lookup-bot",), ("deep-research-tool",), ("x",)], "endpoint_name string")
    found = {r["endpoint_name"]: r for r in resolve_retrieval(frame).collect()}
    assert (found["quick-lookup-bot"]["retrieval_top_k"], found["quick-lookup-bot"]["final_top_k"]) == (20, 3)
    assert (found["deep-research-tool"]["retrieval_top_k"], found["deep-research-tool"]["query_rewrite"]) == (50, True)
    assert (found["x"]["final_top_k"], found["x"]["query_type"]) == (5, "hybrid")


@pytest.mark.parametrize("rule", [{"chunk_size": 5, "overlap": 5}, {"chunk_size": None, "overlap": 1}, {"chunk_size": 5}])
def test_bad_sizes_are_refused_at_load(rule):
    with pytest.raises(ValueError):
        check_chunking({"chunking": {"defaults": {"pdf": {"method": "fixed_size_with_overlap", **rule}}}})


def test_rule_file(tmp_path):
    path = tmp_path / "rules.yml"
    path.write_text("extraction:\n  defaults:\n    pdf: pymupdf_standard\n")
    assert load_rules(str(path))["extraction"]["defaults"] == {"pdf": "pymupdf_standard"}
    check_chunking(CHUNKING_RULES)
    assert set(EXTRACTION_RULES["extraction"]["defaults"]) == set(CHUNKING_RULES["chunking"]["defaults"])


def test_rule_without_folder_fits_any_path(spark):
    from pyspark.sql import functions as F

    from parchline.operators.rules import in_folder

    frame = spark.createDataFrame([("file:/vol/a/x.pdf",), ("file:/vol/ab/x.pdf",)], "p string")
    found = frame.select(*[in_folder(F.col("p"), n).alias(k) for k, n in dict(a="a", b="/a/", c=None, d="", e="vol/a", f="b").items()])
    assert [tuple(r) for r in found.collect()] == [(True, True, True, True, True, False), (False, False, True, True, False, False)]
