"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a DataFrame that the next one reads as Parquet.

quality_classifier drops the documents that the ordinal classifier rejects; simhash_near_dedup keeps one document of each group;
decontamination drops documents with a benchmark passage; mixing emits every document as often as its source's target
asks; sharding puts the result into 24 contiguous shards.  All but the last return the columns of ``documents``; the
last one adds size, text_crc32, shard and slot.

A stage's result has to be written before the next stage is called: each call first deletes what the stages before
it have left in the checkpoint folder, unless its own input still reads it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from cohortlens import session
from cohortlens.llm import decontam, mixing, quality_classifier, sharding, simhash
from cohortlens.llm.common import table


#: Scratch folders of earlier stages, by Spark application.
_SPENT: dict[str, list[str]] = {}


def stage_of(fn):
    """A stage that deletes the scratch folders of the stages before it and notes its own ones."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        read = docs.inputFiles()
        spent = [p for p in _SPENT.get(app, []) if not any(p.split("://")[-1].split(":")[-1] in f for f in read)]
        session.release_scratch(spark, spent)
        before = set(session.scratch_paths(spark))
        try:
            return fn(spark, docs, sf_dir)
        finally:
            _SPENT[app] = [p for p in _SPENT.get(app, []) if p not in spent] + [p for p in session.scratch_paths(spark) if p not in before]
    return run_stage


@stage_of
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.fit(docs, quality_classifier.grades_of(table(spark, sf_dir, "labels")))
    return quality_classifier.select_documents(docs, model)


@stage_of
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=2)


@stage_of
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@stage_of
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


@stage_of
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, 24)


STAGES = [("quality_classifier", classify), ("simhash_near_dedup", deduplicate), ("benchmark_decontamination", decontaminate),
          ("mixing", mix_sources), ("sharding", shard)]
#: The classifier is fitted and scored outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = session.scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        session.release_scratch(spark, written)
        docs, written = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
