"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, folder, con, name):
    frame = entry.queries()[name](spark, folder)
    found = compare(frame, con, entry.oracle_sql()[name])
    assert found in ([], ["no rows"])


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
