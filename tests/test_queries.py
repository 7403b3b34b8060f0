"""Every registered query against its SQL, on whole tables at the smallest scale."""

from __future__ import annotations

import pytest
from compare import connect, mismatch

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in entry.queries().items() if name in entry.CORE}
SQL = {name: text for name, text in entry.oracle_sql().items() if name in entry.CORE}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    assert mismatch(QUERIES[name](spark, FOLDER), database.sql(SQL[name])) is None


def test_queries_without_sql_return_rows(spark):
    rest = set(QUERIES) - set(SQL)
    assert rest == {"report_json"} and not set(SQL) - set(QUERIES)
    for name in rest:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 13 and all(r.evaluation_status == "evaluated" for r in rows)
