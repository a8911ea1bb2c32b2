"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from workload import compare

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    _, difference = compare.compare(spark, db, SF, name, QUERIES[name], SQL.get(name))
    assert difference is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["S08_upload_digest", "S08_document_digest"])
def test_digests_cover_the_documents(spark, name):
    """Copies are found among the documents, with the path of the first."""
    found = QUERIES[name](spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert found.columns == ["digest", "copies", "first_path"]
    assert found.count() >= documents // 40 and found.where("first_path = ''").count() == 0
