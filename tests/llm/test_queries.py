"""Registered queries against their SQL, and without this package."""

import pytest

import __spark_entry__ as entry_module
from contract.compare import compare, open_duckdb
from silvertide.llm.oracle import all_statements
from silvertide.llm.queries import all_queries


@pytest.mark.parametrize("name", sorted(all_statements()))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, open_duckdb(sf_dir), sf_dir, all_queries()[name], all_statements()[name]) == ""


def test_all_are_registered():
    registered = entry_module.queries()
    assert [n for n in all_queries()] == [n for n in registered if n.startswith("op")]
    assert "pipeline" in registered and all_statements().items() <= entry_module.oracle_sql().items()
