"""Offset ledger and start positions.

Ledger rows: ``prefix, group_id, topic, part, until_pos, updated_at, batch_id``. ``until_pos`` is
exclusive, the next position to read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The ledger's lifetime, and the numbers Kafka uses for "newest" and "oldest".
TTL_SECONDS = 172_800
START_POLICIES = {"latest": -1, "earliest": -2}

LEDGER_SCHEMA = (
    "prefix string, group_id string, topic string, part int, until_pos bigint, updated_at timestamp, batch_id bigint"
)
LEDGER_KEY = ["prefix", "group_id", "topic", "part"]


def offset_ranges(batch: DataFrame) -> DataFrame:
    """From and until position per partition of a batch."""
    return batch.groupBy("topic", "part").agg(
        F.min("pos").alias("from_pos"), (F.max("pos") + 1).alias("until_pos")
    )


def ledger_entries(ranges: DataFrame, prefix: str, group_id: str, updated_at: Column, batch_id: int) -> DataFrame:
    """Ledger rows for the ranges of one batch."""
    return ranges.select(
        F.lit(prefix).alias("prefix"),
        F.lit(group_id).alias("group_id"),
        "topic",
        F.col("part").cast("int").alias("part"),
        "until_pos",
        updated_at.alias("updated_at"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def carry_forward(current: DataFrame, entries: DataFrame) -> DataFrame:
    """Adds the partitions that were idle in this batch, refreshed to its time: expiry counts from
    the last write, busy or not. A ledger has one row per partition."""
    idle = current.join(entries, LEDGER_KEY, "left_anti").select(*LEDGER_KEY, "until_pos")
    both = entries.unionByName(idle, allowMissingColumns=True)
    latest = Window.partitionBy()
    return both.withColumns({name: F.max(name).over(latest) for name in ("updated_at", "batch_id")})


def current_ledger(log: DataFrame) -> DataFrame:
    """The last written entry per partition."""
    last = F.max_by(F.struct("until_pos", "updated_at", "batch_id"), F.struct("updated_at", "batch_id"))
    return log.groupBy(*LEDGER_KEY).agg(last.alias("_l")).select(*LEDGER_KEY, "_l.*")


def load_ledger(log: DataFrame, prefix: str, group_id: str, topic: str) -> DataFrame:
    """``part, until_pos`` of one consumer group and topic."""
    mine = log.filter((F.col("prefix") == prefix) & (F.col("group_id") == group_id) & (F.col("topic") == topic))
    return current_ledger(mine).select("part", "until_pos")


def ledger_keys(ledger: DataFrame) -> DataFrame:
    """The ledger as text: ``key`` = ``prefix:group:topic:part``, ``value`` = position."""
    return ledger.select(
        F.concat_ws(":", "prefix", "group_id", "topic", F.col("part").cast("string")).alias("key"),
        F.col("until_pos").cast("string").alias("value"),
    )


def parse_ledger_keys(store: DataFrame, prefix: str, group_id: str, topic: str) -> DataFrame:
    """``part, until_pos`` from text keys (T3). The partition is the last part of the key. An empty
    value gives a null position, so that :func:`start_positions` falls back to its policy."""
    head = f"{prefix}:{group_id}:{topic}:"
    part = F.element_at(F.split("key", ":"), -1).try_cast("int")
    return (
        store.filter(F.col("key").startswith(head))
        .select(part.alias("part"), F.col("value").try_cast("bigint").alias("until_pos"))
        .filter(F.col("part").isNotNull())
    )


def live_ledger(ledger: DataFrame, as_of: Column, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Entries written less than ``ttl_seconds`` before ``as_of`` (T5)."""
    return ledger.filter(F.col("updated_at") + F.make_dt_interval(secs=F.lit(ttl_seconds)) > as_of)


def start_positions(partitions: DataFrame, ledger: DataFrame, policy: str = "latest") -> DataFrame:
    """Where each partition starts (S2): the stored position, else the policy's."""
    stored = ledger.select("part", "until_pos")
    joined = partitions.join(stored, "part", "left")
    return joined.select("part", F.coalesce("until_pos", F.lit(START_POLICIES[policy]).cast("bigint")).alias("start_pos"))


class UnknownPartitions(ValueError):
    """The ledger holds positions of partitions that are not among those to read."""


def checked_partitions(ledger: DataFrame, partitions: int | None) -> int | None:
    """The number of partitions to start at stored positions: every one the ledger knows has to be among
    them, or its messages would be left out. None when the ledger is empty, and no number is needed."""
    known = ledger.agg(F.max("part")).first()[0]
    if known is None:
        return None
    if partitions is None:
        raise UnknownPartitions(f"the ledger holds positions up to partition {known}: say how many partitions there are")
    if known >= partitions:
        raise UnknownPartitions(f"the ledger holds a position of partition {known}, beyond the {partitions} given")
    return partitions


def starting_offsets(topic: str, positions: DataFrame) -> str:
    """The Kafka source's ``startingOffsets`` text. Collects one number per topic partition."""
    return json.dumps({topic: {str(row.part): row.start_pos for row in positions.orderBy("part").collect()}})
