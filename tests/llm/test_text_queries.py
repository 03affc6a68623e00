"""The registered text queries and the pipeline over the given tables."""

import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillwise.llm import queries, toxicity
from tillwise.llm.common import read

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_queries_with_sql(spark, name):
    sys.path.insert(0, "/root/repo")
    import check

    assert check.compare(spark, SF, name, queries.QUERIES[name], queries.CHECKS[name])[0] is None


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.CHECKS and n != "pipeline"])
def test_queries_give_a_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, SF)
    ids = read(spark, SF, "documents").select("doc_id")
    assert got.count() == ids.count() and got.select("doc_id").exceptAll(ids).isEmpty()


def test_pipeline_stages(spark):
    """Each stage on what the one before kept; all but the last give the columns of documents."""
    docs = read(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        rows = spark.createDataFrame(out.collect(), docs.schema)
        assert out.schema.names == docs.schema.names, name
        assert rows.select("doc_id").distinct().join(kept, "doc_id", "left_anti").isEmpty()
        kept = rows
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count() and last.where(F.size("ids") != F.col("n_tokens")).isEmpty()


def test_pipeline_of_nothing(spark, tmp_path):
    for table in ("documents", "labels"):
        read(spark, SF, table).limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxic_stage_drops_what_the_query_predicts(spark):
    docs = read(spark, SF, "documents")
    kept = corpus_pipeline.toxic_out(spark, docs, SF)
    predicted = queries.op2_toxicity(spark, SF).where("predicted = 1").select("doc_id")
    assert kept.select("doc_id").join(predicted, "doc_id").isEmpty()
    assert kept.count() + predicted.count() == docs.count()
