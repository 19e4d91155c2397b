"""Message sources: files and Kafka, batch and streaming."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic string, part int, pos bigint, ts timestamp, value string"
# Rows a task parses. Splits tell little of them: a row of a column file may be a few bytes, and a row group is never split.
TASK_ROWS = 100_000


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def stream_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files as a message stream; the stand-in where there is no broker."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def offsets_per_trigger(rate_per_partition: int, partitions: int, interval_seconds: float) -> int:
    """Cap per micro-batch from a cap per partition and second (S3)."""
    return max(1, math.floor(rate_per_partition * partitions * interval_seconds))


def kafka_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. ``starting_offsets`` counts only until a checkpoint exists."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The Kafka source as a message stream. Needs the spark-sql-kafka package on the class path."""
    return from_kafka(spark.readStream.format("kafka").options(**options).load())


def from_kafka(records: DataFrame) -> DataFrame:
    return records.select(
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("pos"),
        F.col("timestamp").alias("ts"),
        F.col("value").cast("string").alias("value"),
    )


def trigger(interval_seconds: float | None) -> dict:
    """Arguments for ``DataStreamWriter.trigger`` (S4); None works off the backlog and stops."""
    if interval_seconds is None:
        return {"availableNow": True}
    return {"processingTime": f"{interval_seconds} seconds"}


def spread(rows: DataFrame, slots: int, *keys: str, ranges: bool = False) -> DataFrame:
    """Spreads a scan over as many tasks as the cluster has ``slots``, for parsing is CPU-bound, and over more where a task would get above
    ``TASK_ROWS`` rows; files count these in their footers. An input with more splits than that is left as it was split: no shuffle
    stands between the scan and the parse. With ``ranges`` rows that are near each other in ``keys`` stay so."""
    tasks = max(slots, math.ceil(rows.count() / TASK_ROWS))
    if rows.rdd.getNumPartitions() >= tasks:
        return rows
    return rows.repartitionByRange(tasks, *keys) if ranges else rows.repartition(tasks, *keys)
