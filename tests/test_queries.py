"""Every registered query against its SQL, on the smallest tables."""

import unicodedata

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from conftest import SMALL
from docfields.catalog import all_queries

QUERIES = {name: query.run for name, query in all_queries().items()}
SQL = {name: query.sql for name, query in all_queries().items() if query.sql}
ROWS_ONLY = {"normalized_documents"}


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, connection):
    if name in ROWS_ONLY:
        documents = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
        found = {r.doc_id: r.text for r in QUERIES[name](spark, SMALL).collect()}
        assert found == {k: unicodedata.normalize("NFKC", t) for k, t in documents.items()}
    else:
        assert compare(QUERIES[name](spark, SMALL), SQL[name], connection) is None


def test_flagship_query_has_rows(spark):
    assert entry.entry(spark).count() == 1500


def test_every_sql_belongs_to_a_query():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and not set(SQL) - set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
