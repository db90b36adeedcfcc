"""The corpus pipeline: five stages over the documents table, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. Nulls, empty texts, repeated rows and empty tables are treated as the
operators' docstrings say; a stage never drops a row for another reason than its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkstats.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from linkstats.llm.common import table
from linkstats.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: the classifier is fitted on the labelled documents; those scored 0.5 or more go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: of equal texts the smallest doc_id stays."""
    return exact_dedup.keep_first(docs, exact_dedup.DigestIndex(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: of documents linked at 0.8 of their 5-word shingles the smallest doc_id stays."""
    return near_dedup.keep_one_of_each(docs, k=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents that overlap with a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: how many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_benchmark_leaks), ("mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents of ``sf_dir`` that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# A classifier and a random sample are not expressible in SQL; tests/llm checks the stages
# against brute force.
ORACLE_SQL = None
