"""Every registered query against its SQL, and against wrong SQL."""

import pytest

import __spark_entry__ as entry_module
from contract.compare import compare, open_duckdb
from contract.oracle import all_statements
from contract.queries import all_queries

QUERIES, STATEMENTS = all_queries(), all_statements()


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_duckdb(sf_dir)


def test_coverage():
    assert set(QUERIES) == set(STATEMENTS)
    assert entry_module.queries().keys() >= QUERIES.keys()
    assert entry_module.oracle_sql().items() >= STATEMENTS.items()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], STATEMENTS[name]) == ""


def test_comparison_notices_differences(spark, con, sf_dir):
    run = QUERIES["training_count"]
    right = STATEMENTS["training_count"]
    assert compare(spark, con, sf_dir, run, right.replace("count(*) AS total", "count(*) + 1 AS total")).startswith("rows")
    assert compare(spark, con, sf_dir, run, right.replace("AS total", "AS otro")).startswith("columns")
    assert compare(spark, con, sf_dir, run, right.replace("count(*) AS total", "CAST(count(*) AS INTEGER) AS total")).startswith("types")


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "total_alertas" in df.columns
