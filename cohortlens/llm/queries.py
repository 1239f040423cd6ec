"""Registered queries of the corpus operators: name -> function of (spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontam, huffman, jaccard, licenses, linededup, mixing, quality_classifier, quality_rules, runs, sharding, simhash, url_filter, whitening
from cohortlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_huffman_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


SQL["op2_url_filter"] = url_filter.ORACLE


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


SQL["op6_mixing"] = mixing.ORACLE


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


@query
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(table(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(spark, sf_dir, "documents"))
