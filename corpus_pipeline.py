"""The corpus pipeline: documents through the training-data operators, each stage written and read again.

Each stage takes all rows that the one before kept, and all of their columns; n_chars follows where a text changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm.decontaminate import remove_leaks
from tallyspark.llm.neardup import drop_near_duplicates
from tallyspark.llm.packing import pack
from tallyspark.llm.repeats import remove_repeats
from tallyspark.llm.tables import bounded, read, settle
from tallyspark.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learnt from the labels, scores 0.5 or more go."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links of a similarity of 0.8 on five-word shingles, the smallest doc_id stays."""
    bounded(spark)
    return drop_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes that a document with a smaller doc_id has are cut out; every document stays."""
    bounded(spark)
    return remove_repeats(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; every document stays."""
    bounded(spark)
    return remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens: a row per piece with its place."""
    bounded(spark)
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_near_duplicates),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_leaks),
    ("best_fit_packing", packed),
]

#: SQL can express neither a learnt score nor a packing: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
