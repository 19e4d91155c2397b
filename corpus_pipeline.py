"""From raw documents to training sequences: five stages over the operators of ``keyfold.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyfold.llm import exact_dedup, mixing, near_dedup, packing, quality
from keyfold.llm.common import documents, small_batches, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    small_batches(spark)
    return exact_dedup.without_copies(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return near_dedup.without_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids as sequences."""
    small_batches(spark)
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("exact_dedup", distinct),
    ("near_dedup", unlike),
    ("mixing", mixed),
    ("packing", packed),
]

# The classifier, the near copies and the tokens are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage keeps is written, and read by the next."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
