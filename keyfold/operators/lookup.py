"""Reads of the stored state (L1-L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions import glob_prefix, glob_to_regex

# The fields a point lookup returns unless told otherwise.
DEFAULT_FIELDS = ("latest_days_visited_at", "visited_products")


def point_get(fields: DataFrame, doc_id: str, names: tuple[str, ...] = DEFAULT_FIELDS) -> DataFrame:
    """The named fields of one document (L1), from rows that have ``id`` and ``field``.

    Both conditions are plain comparisons, so they reach the scan: on the bucketed snapshot one
    bucket is read, and row groups are skipped by their statistics.
    """
    return fields.filter((F.col("id") == doc_id) & F.col("field").isin(*names))


def multi_get(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """All rows of the wanted ids that exist (L2).

    No broadcast hint: adaptive execution broadcasts the ids if their measured size allows it and
    joins by shuffle otherwise. Call it on messages to merge only the wanted documents.
    """
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def pattern_get(store: DataFrame, pattern: str) -> DataFrame:
    """Key and value of every key that matches a glob (L3), each key once.

    The literal start of the pattern is a prefix filter that Parquet can check per row group.
    """
    found = store.filter(F.col("key").startswith(glob_prefix(pattern)) & F.col("key").rlike(glob_to_regex(pattern)))
    return found.groupBy("key").agg(F.max("value").alias("value"))
