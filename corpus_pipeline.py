"""The corpus pipeline: five stages, each applying one operator to all that is left.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crowdgrid.llm import mixing, near_duplicates, packing, quality_classifier, repeated_passages
from crowdgrid.llm.common import table
from crowdgrid.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8)."""
    return near_duplicates.keep_one(docs, words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that are found twice are cut out of every text."""
    return repeated_passages.remove_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, interleaved to weights by the root of the sources' sizes."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their sequence and place, in the mixed order."""
    return packing.pack_documents(docs, added=packing.added_tokens(), in_order=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing", mix),
    ("packing", pack),
]

# SQL can express neither the classifier nor the tokens; the tests hold each stage against a
# brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
