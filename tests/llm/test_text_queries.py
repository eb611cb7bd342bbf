"""Registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from peopleflow.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    wanted = connection.execute(ORACLES[name]).df()
    found = QUERIES[name](spark, FOLDER).toPandas()
    columns = sorted(wanted.columns)
    assert columns == sorted(found.columns)
    wanted, found = (x[columns].sort_values(columns).reset_index(drop=True) for x in (wanted, found))
    assert len(wanted) == len(found) and (wanted.astype(str) == found.astype(str)).all().all()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).toPandas(), docs.schema)
        assert docs.columns == columns, name
    after = docs.count()
    assert 0 < after < before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == after
    assert packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048
