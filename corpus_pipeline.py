"""Corpus pipeline over ``documents``: five stages, each over all its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last one returns what
the mix takes of each document. Nulls, empty tables and repeated rows follow the operators' docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import debruijn, decontaminate, mixing, rules, simhash
from gaugeworks.llm.shared import DOCUMENTS, prepared, table
from gaugeworks.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules reject go."""
    return rules.accepted(docs.select(*DOCUMENTS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    prepared(spark)
    return simhash.deduplicated(docs.select(*DOCUMENTS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages of 20 or more words that an earlier place has go; ``n_chars`` follows."""
    prepared(spark)
    return debruijn.without_repeats(docs.select(*DOCUMENTS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover at least 5 % of the words go."""
    prepared(spark)
    return decontaminate.clean(docs.select(*DOCUMENTS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words of each document in the mix."""
    return mixing.mixed(docs.select(*DOCUMENTS))


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup),
    ("decontamination", decontamination), ("mixing", mix),
]
ORACLE_SQL = None  # estimation and fingerprints are beyond SQL; tests compare the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage returns is written to the shared folder and read by the next."""
    docs, folder = table(spark, sf_dir, "documents"), work_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
