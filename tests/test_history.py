"""The captures of each path over time, on small tables with gaps and repeats."""

import duckdb
import pytest

import __spark_entry__ as entry
from parchline.plans.lifecycle import history_view
from tests.oracle import compare

DOCUMENTS = [
    (1, "labelled", "src1"),
    (2, "not labelled", "src1"),
    (3, "labelled twice", "src2"),
    (4, "labelled", None),
    (5, "not labelled, later, but not by a day", None),
    (6, None, "src1"),
    (None, "without a number", "src1"),
    (1, "the same number, another source", "src10"),
]
LABELS = [(1,), (3,), (3,), (4,), (6,), (99,), (None,)]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("history"))
    spark.createDataFrame(DOCUMENTS, "doc_id bigint, text string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id bigint").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_labelled_documents_are_captured_twice(spark, small):
    rows = history_view(spark, small).collect()
    seen = [r["source_path"] for r in rows]
    assert len(rows) == len(DOCUMENTS) + 5
    assert seen.count("file:/vol/src1/1.txt") == seen.count("file:/vol/src10/1.txt") == 2
    assert seen.count("file:/vol/src2/3.txt") == 2 and seen.count("file:/vol/src1/2.txt") == 1


def test_latest_instance_equals_sql_with_gaps_and_repeats(spark, small):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet/*.parquet')")
    found = entry.queries()["latest_instance"](spark, small)
    assert compare(found, con, entry.oracle_sql()["latest_instance"]) == []
    assert found.filter("source_path IS NULL").count() == 1
