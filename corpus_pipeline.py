"""From raw documents to token ids: five stages, each reading the table that the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import bpe, decontaminate, exact_dedup, ngram_join, toxicity
from lakeloom.llm.common import documents
from lakeloom.session import materialise

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", exact_dedup.stage),
    ("ngram_join", ngram_join.stage),
    ("decontaminate", decontaminate.stage),
    ("bpe", bpe.stage),
]

#: Trained classifiers and set similarity over components are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result stored under the shared folder before the next one reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
