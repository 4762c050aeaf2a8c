"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but
the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm import decontamination, jaccard, packing, secret_scan, toxicity
from tidecast.llm.common import saved, table
from tidecast.llm.queries import toxic_model
from tidecast.llm.signature_tree import Threshold


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its limit; null and empty texts stay."""
    return toxicity.without_toxic(docs, toxic_model(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of texts that five-word shingles link at 0.8."""
    return jaccard.one_of_each(docs, words=5, threshold=Threshold(80, 100))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of benchmark passages."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"), window=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.packed(docs, tokenizer="byte_bpe_50k", window=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: No SQL learns the classifier or tokenises; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
