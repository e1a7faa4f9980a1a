import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import jaccard, packing, privacy
from tidemark.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf_dir, same):
    same(QUERIES[name](spark, sf_dir), SQL[name])


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        assert docs.columns == before.columns and set(docs.dtypes) == set(before.dtypes)
        seen[name] = (before, docs)
    before, after = seen["near_duplicates"]
    lead = jaccard.near_duplicates(before, words=corpus_pipeline.NEAR_WORDS, percent=corpus_pipeline.NEAR_PERCENT).where("doc_id = component_id").select("doc_id").distinct()
    assert sorted(r[0] for r in lead.collect()) == sorted(r[0] for r in after.select("doc_id").distinct().collect())
    before, after = seen["privacy"]
    spans = {r["doc_id"]: r["spans"] for r in privacy.find(before).collect()}
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        assert (r["text"] == texts[r["doc_id"]]) == (not spans[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= packing.CAPACITY
