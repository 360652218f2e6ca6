"""From raw documents to packed training sequences.

Stages in order: toxic documents go, of exact copies one row stays, of near
copies one row stays, what is left is packed.  Each stage reads what the one
before wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import packing, stages
from folioscope.llm.common import table
from folioscope.llm.queries import RANKS, SPECIALS
from folioscope.session import remove, scratch, shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.without_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.without_near_copies(docs, words=3, distance=2)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(RANKS), 2048, 0, SPECIALS)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; tables between stages go to the shared folder.

    A stage's table goes when the next one is written, and so do the checkpoints of
    a stage; the last table is the result.  One run at a time in a session.
    """
    folder = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        docs, before = spark.read.parquet(f"{folder}/{name}"), name
    return docs


# Scores, SimHash and tokenization have no SQL; tests compare with brute force.
ORACLE_SQL = None
