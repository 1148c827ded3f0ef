"""The corpus pipeline: five stages from raw documents to a shuffled training mix.

Each stage takes ``(spark, docs, sf_dir)``; its result is written and read again as the next
one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from townvoice.llm.common import materialize, table  # noqa: E402
from townvoice.llm.decontamination import decontaminated  # noqa: E402
from townvoice.llm.mixing import mixed  # noqa: E402
from townvoice.llm.neardup import without_copies  # noqa: E402
from townvoice.llm.sharding import external_shuffle  # noqa: E402
from townvoice.llm.toxicity import without_toxic  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels and the texts of ``documents``."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, similarity 0.8)."""
    return without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get their target weights; a document may come up to three times, or not at all."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order, with ``size``, ``shard`` and ``slot``."""
    return external_shuffle(docs)


STAGES = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]
# classifiers, signatures and random order are beyond SQL: tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
