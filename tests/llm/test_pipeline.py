"""The pipeline's stages, and every registered query of the subpackage."""

from collections import Counter

import pytest

import corpus_pipeline
from vigil.llm.all import QUERIES

SF = "/root/testdata/sf0.001"
OPERATORS = [n for n in QUERIES if n.startswith("op")]


def test_fourteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in OPERATORS) == list(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_query_returns_every_document(spark, name):
    found = QUERIES[name](spark, SF)
    key = {"op5": "query_id", "op12": "conv_id"}.get(name.split("_")[0], "doc_id")
    ids = {r[0] for r in found.select(key).collect()}
    if key == "doc_id":
        wanted = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    elif key == "conv_id":
        # Nodes are named by the smallest of their conversations.
        wanted = ids & {r[0] for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").collect()}
    else:
        wanted = {r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 20 = 0")
                  .select("vec_id").collect()}
    assert ids == wanted


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.count()]
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, given, SF).write.parquet(path)
        found = spark.read.parquet(path)
        if name != "packing":
            assert found.dtypes == docs.dtypes
        else:
            assert {r[0] for r in found.select("doc_id").collect()} == {
                r[0] for r in given.select("doc_id").collect()}
        seen.append(found.count())
        given = found
    assert seen[0] > seen[1] > seen[2] == seen[3] <= seen[4]
    whole = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == Counter(tuple(r) for r in given.collect())
