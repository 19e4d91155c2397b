"""The three jobs: one ``foreachBatch`` function each.

The order inside a batch is fixed: all sinks, then metrics, then the ledger. The query's checkpoint
decides what is read again after a failure; the ledger is there to be queried and to seed a new
checkpoint. With ``committed`` tables nothing of a batch is seen before all of it is, and a batch that was committed is not
written again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyfold.operators import messages, profiles, progress, signals
from keyfold.operators.deep_merge import STATE_SCHEMA, state_rows
from keyfold.operators.merge import TIME_ORDER, keep_last
from keyfold.sources.message_log import trigger
from keyfold.streaming.commits import CommitLog, CommittedTable, Transaction
from keyfold.streaming.levels import LeveledStore
from keyfold.streaming.tables import (
    METRICS_SCHEMA,
    QUARANTINE_SCHEMA,
    QUEUE_SCHEMA,
    BatchTable,
    DocumentStore,
)

OUTCOME_SCHEMA = (
    "sink string, task int, id string, reason string, rows bigint, bytes bigint, bulks bigint, ms bigint"
)
# Set by Spark for the jobs of a stream: a query keeps its id as long as its checkpoint lives.
_QUERY_ID = "sql.streaming.queryId"
# So much of a batch, as a shuffle holds it, is parsed by one task and cached in one piece, which takes ten times the room or more.
# Without adaptive execution there are as many pieces as ``spark.sql.shuffle.partitions`` says.
PARSE_BYTES = "2MB"
# Without the second a cache has the partitions of the shuffle, however little is in them.
_PIECES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARSE_BYTES,
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


@dataclass(frozen=True)
class JobConfig:
    """Parameters of a job. ``root`` is the folder of its output tables."""

    root: str
    prefix: str = "app"
    group_id: str = "g1"
    queue: str = signals.TASK_QUEUE
    order: tuple[str, ...] = TIME_ORDER
    null_policy: str = "overwrite"
    nested: bool = True
    # extra document sinks, each called with a :class:`Written` batch; what they return counts as failed
    sinks: tuple[Callable[[Written], int | None], ...] = ()
    # fold the changes into a snapshot every so many batches; 0 leaves that to someone else
    compact_every: int = 0
    buckets: int = 16
    unquoted_names: bool = False
    # one commit a batch for all tables, and the store in levels; its buckets are split at so many rows
    committed: bool = False
    bucket_rows: int = 20_000_000


LEDGER_TABLE_SCHEMA = "prefix string, group_id string, topic string, part int, until_pos bigint, updated_at timestamp"


class JobTables:
    """The output tables of a job."""

    def __init__(self, spark: SparkSession, config: JobConfig):
        root = config.root.rstrip("/")
        self.spark = spark
        self.transaction: Transaction | None = None
        self.log = CommitLog(spark, root) if config.committed else None
        merging = config.order, config.null_policy, config.nested

        def table(name: str, schema: str) -> BatchTable | CommittedTable:
            if self.log is None:
                return BatchTable(spark, f"{root}/{name}", schema)
            return CommittedTable(self.log, name, schema, self._current)

        if self.log is None:
            self.store = DocumentStore(spark, f"{root}/documents", *merging)
        else:
            sizes = {"buckets": config.buckets, "bucket_rows": config.bucket_rows}
            self.store = LeveledStore(self.log, *merging, **sizes, current=self._current)
        self.queue = table("queue", QUEUE_SCHEMA)
        self.quarantine = table("quarantine", QUARANTINE_SCHEMA)
        self.metrics = table("metrics", METRICS_SCHEMA)
        self.outcome = table("outcome", OUTCOME_SCHEMA)
        # what sinks send again, and what they have given up
        self.waiting = table("waiting", f"{STATE_SCHEMA}, reason string, attempts int, due timestamp, at timestamp")
        self.dead = table("dead", "sink string, id string, source string, reason string, attempts int")
        self.ledger = table("ledger", LEDGER_TABLE_SCHEMA)

    def _current(self) -> Transaction | None:
        return self.transaction

    @contextmanager
    def batch(self, run: str, batch_id: int) -> Iterator[bool]:
        """The writes of a batch; committed tables show them when it ends well. False if it was committed before."""
        if self.log is None:
            yield True
            return
        transaction = Transaction(self.log, run, batch_id)
        if transaction.done():
            yield False
            return
        self.transaction = transaction
        try:
            yield True
            transaction.commit()
        finally:
            self.transaction = None


@dataclass(frozen=True)
class Written:
    """A batch whose change rows are in the store."""

    tables: JobTables
    run: str
    batch_id: int

    def changes(self) -> DataFrame:
        """The merged state rows of the batch, as they were written."""
        return self.tables.store.changes.read_batch(self.batch_id, self.run).drop("run", "batch_id")


BatchFunction = Callable[[DataFrame, int], None]


def document_job(config: JobConfig) -> BatchFunction:
    """Documents upserted field by field, signals queued."""
    return _batch_function(config, lambda parsed: _states(messages.documents(parsed), config), with_signals=True)


def keep_last_job(config: JobConfig) -> BatchFunction:
    """As :func:`document_job`, but within a batch the newest message of an id stands alone."""

    def newest(parsed: DataFrame) -> DataFrame:
        docs = messages.documents(parsed).select("id", "fields", "ts", "part", "pos")
        return _states(keep_last(docs, config.order), config)

    return _batch_function(config, newest, with_signals=True)


def profile_job(config: JobConfig) -> BatchFunction:
    """User profiles upserted by ``app_id|user_id``; no signals."""
    return _batch_function(
        config, lambda parsed: profiles.profile_state(profiles.profiles(parsed), config.order), with_signals=False
    )


def _states(docs: DataFrame, config: JobConfig) -> DataFrame:
    return state_rows(docs, config.null_policy, config.order, config.nested)


@contextmanager
def _in_pieces(spark: SparkSession) -> Iterator[None]:
    """What is cached and computed meanwhile is cut by ``_PIECES``."""
    before = {name: spark.conf.get(name) for name in _PIECES}
    try:
        for name, value in _PIECES.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _batch_function(
    config: JobConfig, to_states: Callable[[DataFrame], DataFrame], with_signals: bool
) -> BatchFunction:
    ledger = _Ledger(config)

    def run(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        spark = batch.sparkSession
        # whatever the session: of a nested object's repeated keys the last one wins
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
        own_run = spark.sparkContext.getLocalProperty(_QUERY_ID)
        if not own_run:
            raise RuntimeError("a job runs as a streaming query; write single batches with the store's write")
        tables = JobTables(spark, config)
        # however few splits the source has: its size shows in the shuffle only, as the batch is read once
        even = batch.hint("rebalance", "part", "pos")
        with _in_pieces(spark):
            parsed = messages.parse_messages(even, config.unquoted_names).persist()
        try:
            with tables.batch(own_run, batch_id) as fresh:
                if fresh:
                    write(tables, parsed, batch_id, own_run, started)
            if config.compact_every and (batch_id + 1) % config.compact_every == 0 and tables.store.compact(config.buckets):
                tables.store.clean()
        finally:
            parsed.unpersist()

    def write(tables: JobTables, parsed: DataFrame, batch_id: int, own_run: str, started: float) -> None:
        spark = parsed.sparkSession
        if with_signals:
            reasons = {"document": messages.document_reason(), "signal": signals.signal_reason()}
        else:
            reasons = {"profile": profiles.profile_reason()}
        # one row per topic partition: counts and positions; computing it fills the cache in parallel
        with _in_pieces(spark):
            counted = batch_metrics(parsed, reasons, ["topic", "part"], F.max("pos").alias("last_pos")).collect()
        if not counted:
            return
        totals = [sum(row[name] for row in counted) for name in COUNTS]
        found = dict(zip(COUNTS, totals))
        if found["rejected"]:
            tables.quarantine.write(messages.rejects(parsed, **reasons), batch_id, own_run)
        tables.store.write_rows(to_states(parsed), batch_id, own_run)
        written = Written(tables, own_run, batch_id)
        failed = sum(sink(written) or 0 for sink in config.sinks)
        if with_signals and found["signals"]:
            queued = signals.queue_rows(signals.signals(parsed), config.queue)
            tables.queue.write(queued, batch_id, own_run)

        elapsed = int((time.monotonic() - started) * 1000)
        names = [getattr(sink, "name", getattr(sink, "__name__", "sink")) for sink in config.sinks]
        row = spark.createDataFrame([(*totals, failed, names, elapsed)], METRICS_SCHEMA)
        tables.metrics.write(row, batch_id, own_run)
        ledger.save(tables.ledger, counted, batch_id, own_run)

    return run


COUNTS = ("messages", "bytes", "documents", "signals", "rejected")


def batch_metrics(parsed: DataFrame, reasons: dict, by: list | None = None, *more) -> DataFrame:
    """Counts of a batch (K4) in one pass: messages, bytes, documents, signals, rejected. A message
    counts as rejected when any branch turned it down."""
    is_signal = signals.signal_flag()
    rejected = F.coalesce(*reasons.values()).isNotNull()
    return parsed.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("bigint").alias("bytes"),
        F.count_if(next(iter(reasons.values())).isNull()).alias("documents"),
        F.count_if(is_signal).alias("signals"),
        F.count_if(rejected).alias("rejected"),
        *more,
    )


class _Ledger:
    """Writes the ledger (T2). Every set of entries is complete: partitions that were idle are carried forward, so
    expiry counts from the last write, busy or not. A ledger has one row per topic partition, and what was
    written last is remembered; a job that starts reads it from the table."""

    def __init__(self, config: JobConfig):
        self.config = config
        self.last: tuple[str, int] | None = None
        self.known: dict[tuple, int] = {}

    def save(self, table: BatchTable, counted: list, batch_id: int, run: str) -> None:
        if self.last is None or self.last[0] != run or self.last[1] >= batch_id:
            current = progress.current_ledger(table.read(_before(table, run, batch_id)))
            self.known = {(r.prefix, r.group_id, r.topic, r.part): r.until_pos for r in current.collect()}
        own = self.config.prefix, self.config.group_id
        self.known |= {(*own, row.topic, row.part): row.last_pos + 1 for row in counted}
        now = datetime.now(timezone.utc)
        entries = table.spark.createDataFrame([(*key, pos, now) for key, pos in self.known.items()], table.schema)
        table.write(entries.coalesce(1), batch_id, run)
        self.last = run, batch_id


def _before(ledger: BatchTable, run: str, batch_id: int) -> list[tuple[str, int]]:
    """The last folder of this run before the batch: empty batches leave none. Of a run without any, all
    folders of the others."""
    folders = ledger.folders().batches()
    own = [b for b in folders if b[0] == run and b[1] < batch_id]
    return own[-1:] or [b for b in folders if b[0] != run]


def without_replays(stream: DataFrame, window: str) -> DataFrame:
    """A message stream without what was read before: a position of a partition that comes again within ``window`` of its arrival.

    Arrival is the time of the batch, so no message is ever too late, and what is remembered is bounded by the window. A message
    without a position cannot be told from others and stays. The positions are kept in Spark's state store, by partition of the shuffle;
    with windows of many messages let it be on disk (``spark.sql.streaming.stateStore.providerClass``).
    """
    position = ["topic", "part", "pos"]
    unknown = F.col("part").isNull() | F.col("pos").isNull()
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withColumn("_own", F.when(unknown, F.uuid()))
    fresh = arrived.withWatermark("_arrived", window).dropDuplicatesWithinWatermark([*position, "_own"])
    return fresh.drop("_arrived", "_own")


def start(
    stream: DataFrame, run: BatchFunction, checkpoint: str, interval_seconds: float | None = None, name: str | None = None
) -> StreamingQuery:
    """Starts a job. Without an interval it works off the backlog and stops."""
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger(interval_seconds)).start()


def work_off(stream: DataFrame, run: BatchFunction, checkpoint: str, name: str | None = None) -> None:
    """Runs a job until nothing is left, in as many batches as the source's cap asks for. A source that caps itself by its offsets needs
    this: working off a backlog in one go is for sources that Spark caps."""
    query = start(stream, run, checkpoint, 0, name)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
