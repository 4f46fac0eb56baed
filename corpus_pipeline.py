"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go, then all but one of equal texts, then all but one of near duplicates, then documents that hold a
benchmark item; what is left is packed into token windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringspan.llm import decontaminate, packing, radix, simhash, toxicity
from ringspan.llm.common import table
from ringspan.llm.tokens import vocabulary_path
from ringspan.session import discard, scratch, scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents not rejected by the classifier fitted on their own labels."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest id."""
    return radix.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 2 or fewer of 64 bits, three-word shingles."""
    return simhash.keep_one_of_each(docs, shingle=3, distance=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, vocabulary_path(), window=1024, end_id=0)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL can state neither the classifier nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all stages' documents. What a stage stored for itself, and its input, go when its rows are written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            discard(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
