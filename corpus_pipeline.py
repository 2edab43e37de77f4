"""Corpus pipeline over ``documents``: language ID, near duplicates, benchmark
decontamination, mixing, sharding. Every stage but the last returns the
columns of ``documents``; each is written as Parquet and reread as the next
one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from instalytics.llm import decontaminate, language_id, mixing, ngram_join, sharding
from instalytics.llm.common import staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without evidence for any one language go."""
    return language_id.identified(docs, language_id.fit(language_id.training_rows(docs)))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return ngram_join.first_documents(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the Pfair schedule of the sources' natural shares."""
    return mixing.mixture(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document of the mixture; inside a shard they
    stand in the order of the schedule, in which the stage before wrote them."""
    return sharding.shard_documents(docs, in_file_order=sharding.has_file_order(docs)).drop("grp")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", remove_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# language ID learns a classifier, which SQL cannot express; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
