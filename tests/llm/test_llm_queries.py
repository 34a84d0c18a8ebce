"""Registered queries of logloom.llm: SQL where there is some, and the pipeline's stages."""

import pytest
from compare import compare, oracle_connection
from conftest import SF_DIR

import corpus_pipeline
from logloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = oracle_connection(SF_DIR)
    assert compare(QUERIES[name](spark, SF_DIR).toPandas(), con.execute(ORACLES[name]).df()) is None


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    n, columns, counts = docs.count(), docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.select("doc_id").distinct().count())
        assert k == 4 or docs.columns == columns
    assert n >= counts[0] >= counts[1] >= counts[2] == counts[3] == counts[4] > 0.8 * n
    assert docs.select("sequence_id", "offset", "length").distinct().count() == docs.count()
