"""Control signals: filter, enrichment and queue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions import entries_of, int_of, object_json, text_of
from keyfold.operators.messages import POSITION, bind, unreadable_reason
from keyfold.session import scratch_path

# Fixed values of the signal contract.
SIGNAL_SOURCE = "tag_operate_queue"
OPERATE_SOURCE = "tag_system_operate"
TASK_DONE = 0
TASK_QUEUE = "tags:task:queue"


def _offered() -> Column:
    """A message from the signal source that carries the last-batch flag at all."""
    fields = F.col("fields")
    return (text_of(fields, "data_source") == SIGNAL_SOURCE) & F.map_contains_key(fields, "is_last_batch")


def signal_reason() -> Column:
    """Why a message is unusable as a signal. Being no signal is not a fault."""
    bad_flag = _offered() & int_of(F.col("fields"), "is_last_batch").isNull()
    return F.coalesce(unreadable_reason(), F.when(bad_flag, "bad_int"))


def signal_flag() -> Column:
    """Whether a parsed message is a last-batch signal."""
    return F.coalesce(_offered() & (int_of(F.col("fields"), "is_last_batch") == 1), F.lit(False))


def signals(parsed: DataFrame) -> DataFrame:
    """Last-batch signals with ``tag_id`` and ``batch_id`` as text and the task columns added.

    ``fields`` holds the enriched message; a signal with an ``id`` is a document as well.
    """
    fields = F.col("fields")
    enriched = {
        "tag_id": text_of(fields, "tag_id"),
        "batch_id": text_of(fields, "batch_id"),
        "operate_source": F.lit(OPERATE_SOURCE),
        "task_status": F.lit(TASK_DONE),
    }
    untouched = F.map_filter(fields, lambda k, _: ~k.isin(*enriched))
    found = parsed.filter(signal_flag()).select(
        *POSITION,
        text_of(fields, "data_source").alias("data_source"),
        int_of(fields, "is_last_batch").alias("is_last_batch"),
        *[column.alias(name) for name, column in enriched.items()],
        untouched.alias("_untouched"),
    )
    # the added entries become variants by way of JSON, where a null text is a missing field
    added = F.from_json(F.to_json(F.struct(*enriched)), "map<string,variant>")
    return bind(found, fields=F.map_concat("_untouched", entries_of(added))).drop("_untouched")


def queue_rows(found: DataFrame, queue: str = TASK_QUEUE) -> DataFrame:
    """One row per pushed signal, payload without null fields."""
    return found.select(F.lit(queue).alias("queue_name"), object_json(F.col("fields")).alias("payload"), *POSITION)


QUEUE_ORDER = ("ts", "part", "pos")


def _head_first() -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in QUEUE_ORDER]


def distinct_pushes(queue: DataFrame) -> DataFrame:
    """Each signal once, however often its message was read."""
    return queue.dropDuplicates(["queue_name", "topic", "part", "pos"])


def newest_first(queue: DataFrame) -> DataFrame:
    """Queue rows in list order, the head first, rows without a time last. A global sort, for the
    reading side only."""
    return queue.orderBy(*_head_first())


def with_place(queue: DataFrame) -> DataFrame:
    """Adds ``place``, each row's position in its list, 1 = head.

    Rows are cut into ranges of their order, whatever their times, and numbered inside a range; the ranges' sizes,
    one row each, shift them. So a burst of one minute is spread as well as a quiet day. The ranges are
    written first, since they are read twice.
    """
    ranged = queue.repartitionByRange(F.col("queue_name"), *_head_first()).sortWithinPartitions("queue_name", *_head_first())
    spark, path = queue.sparkSession, scratch_path(queue.sparkSession, "ranges")
    # the number of a row's partition, and its place in it, make up this id
    numbered = ranged.withColumn("_id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = (
        spark.read.schema(numbered.schema)
        .parquet(path)
        .withColumn("_range", F.shiftright("_id", 33))
        .withColumn("_row", F.col("_id").bitwiseAND(2**33 - 1))
    )
    sizes = rows.groupBy("_range", "queue_name").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("queue_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_range", "queue_name", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    return rows.join(shifts, ["_range", "queue_name"]).select(*queue.columns, (F.col("_row") + F.col("_shift")).alias("place"))
