"""The pipeline: stages over all that the one before kept."""

import corpus_pipeline
from tests.llm import helpers as h


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = h.documents(spark)
    before = {str(r["doc_id"]) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, h.SF_DIR)
        assert out.columns == docs.columns, name
        rows = out.collect()
        ids = {str(r["doc_id"]) for r in rows}
        assert rows and ids <= before
        docs, before = spark.createDataFrame(rows, h.SCHEMA), ids
    last = corpus_pipeline.STAGES[-1][1](spark, docs, h.SF_DIR)
    assert last.count() == docs.count()


def test_run(spark):
    shards = corpus_pipeline.run(spark, h.SF_DIR)
    assert {r["shard"] for r in shards.select("shard").distinct().collect()} == set(range(24))


def test_empty_documents_pass_through(spark):
    docs = h.documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, h.SF_DIR).count() == 0
