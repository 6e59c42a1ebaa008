"""Corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from addrlink.llm import packing, quality_classifier, quality_rules, simhash
from addrlink.llm.common import table
from addrlink.llm.queries import tokenizer
from addrlink.session import ensure_checkpoint_dir


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of good quality.

    The model learns from the labelled rows of the whole table: after the rules
    hardly a bad example is left in ``docs``.
    """
    model = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the sequences."""
    return packing.pack_documents(docs, tokenizer(spark, "word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules), ("quality_classifier", classifier),
    ("simhash", near_duplicates), ("packing", pack),
]

#: Learned scores and tokenizers cannot be written in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage keeps is written as Parquet in the shared folder and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
