import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from cohortlens.llm import decontam, simhash

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = list(E.queries())
    assert [next(n for n in names if n.startswith(f"op{k}_")) for k in range(1, 11)] and "pipeline" in names


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left.append(len(corpus_pipeline._SPENT[spark.sparkContext.applicationId]))
    assert max(left) < 20  # a stage's scratch folders go when the next stage begins
    out = corpus_pipeline.run(spark, SF).cache()
    assert out.count() == docs.count() > 0
    assert out.groupBy("shard").agg((F.max("slot") + 1 == F.count("*")).alias("gapless")).where("not gapless").count() == 0
    kept = out.dropDuplicates(["doc_id"])
    assert kept.groupBy("text").count().where("count > 1").count() == 0
    assert decontam.digest(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    prints = simhash.digest(kept)
    assert prints.where("component_id != doc_id").count() == 0
    out.unpersist()
