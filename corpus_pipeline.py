"""The corpus pipeline: documents pass through the operators one stage after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All stages but the last return the columns of
``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, exact_dedup, ngram_join, packing, toxicity
from ebbtide.llm.common import free_name, table, written


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from every labelled document.

    Without labels of both kinds nothing is rejected.
    """
    name = free_name(docs.columns, "score")
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"), F.lit(True), score_col=name, without_model=0.0)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def similar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more, the one with the smallest id stays."""
    return ngram_join.drop_similar(docs)


def leaked_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with ids, sequence and offset."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_documents),
    ("exact_dedup", exact_copies),
    ("ngram_join", similar_documents),
    ("decontamination", leaked_benchmarks),
    ("packing", packed),
]

#: No SQL for the classifier and the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
