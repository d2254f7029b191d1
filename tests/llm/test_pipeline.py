"""The pipeline's stages against their operators on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm.latent import contaminated
from ledgerline.llm.neardup import near_duplicates

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit("clash"))
    docs = docs.unionByName(docs.where("doc_id = 1"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SF))
        assert out.columns == docs.columns, name
        assert out.exceptAll(docs).isEmpty() and 0 < out.count() <= docs.count(), name
        docs = out
    assert docs.count() == docs.select("doc_id").distinct().count()
    assert near_duplicates(docs).where("not kept").isEmpty()
    assert contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where("not lossless").isEmpty()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
