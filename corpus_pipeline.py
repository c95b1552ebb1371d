"""A training corpus from ``documents``: classify, deduplicate, mix and pack.

Every stage takes what its predecessor kept, written as Parquet and read again, and applies one
operator of ``tideline.llm``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.exact_dedup import keep_first_copies
from tideline.llm.kneser_ney import keep_good
from tideline.llm.mixing import mixed_rows
from tideline.llm.packing import pack_documents
from tideline.llm.queries import vocabulary
from tideline.llm.simhash import keep_one_of_each
from tideline.llm.util import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the perplexity limit of their language."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return keep_first_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix draws them: some several times, some not at all."""
    return mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each drawn document lies in the packed sequences."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]

#: No stage but exact deduplication can be said in SQL; tests/llm compares exact and near deduplication with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
