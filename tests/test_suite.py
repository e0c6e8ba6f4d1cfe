"""Registered queries against their SQL; all of them with KEYLOOM_SUITE=all."""

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import DATA
from tests.oracle import compare, connect

QUICK = [
    "page_next", "get_equal_bulk", "get_less_bulk", "nearest_join_by_user", "with_previous", "step_page_next", "find_percent",
    "decode_records", "key_cardinality", "insert_batch_report", "apply_log", "schema_diff", "read_record_files_mapped",
]
NAMES = list(entry.queries()) if os.environ.get("KEYLOOM_SUITE") == "all" else QUICK


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, DATA) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
