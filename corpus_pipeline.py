"""From raw documents to token files: language, near duplicates, benchmark leaks, mixture, tokens.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``documents``. ``run`` writes each result as Parquet to the
shared folder and reads it again as the next stage's input.

Defined cases: stages follow their operators. Null and empty texts have no language and go in the first
stage; rows are judged one by one, so repeated or null ids lose nothing that is unlike; an empty table
stays empty to the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwarden.functions import sizing
from tabwarden.llm import huffman, language, mixing, simhash_trie, templates


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.accepted(docs, language.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_trie.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return templates.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.emit(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; one row per document, read back from them."""
    return huffman.round_trip(docs)


STAGES = [
    ("language", keep_known_language),
    ("near_copies", drop_near_copies),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("mixture", mix_sources),
    ("tokens", write_tokens),
]

#: The language stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = sizing.cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
