"""The numbered queries against their SQL, and those without SQL for their rows."""

import importlib

import pytest
from compare import compare, duck
from conftest import SF

from veriledger.llm import queries


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF) > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL) - {"op10_chunks"}))
def test_one_row_a_document(spark, name):
    source = "pages" if name == "op7_html_text" else "documents"
    rows = queries.QUERIES[name](spark, SF).count()
    assert rows == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_all_are_registered():
    entry = importlib.import_module("__spark_entry__")
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
