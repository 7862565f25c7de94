"""Every query with SQL against DuckDB on the smallest tables; the others give a row per document."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from feedlens.llm.queries import ORACLES, QUERIES
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, small, name):
    problem, _, _, checked = compare(spark, duck, small, name)
    assert checked and problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_per_document(spark, small, name):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    result = QUERIES[name](spark, small)
    assert sorted(row.doc_id for row in result.select("doc_id").collect()) == sorted(row.doc_id for row in documents.select("doc_id").collect())


def test_all_ten_and_the_pipeline_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in contract.queries() if name.startswith("op") and name[2].isdigit()}
    assert numbers == set(range(1, 11)) and contract.queries()["pipeline"] is corpus_pipeline.run
