"""Batched writer for external stores, as a Python data source (K1, K2, K4).

``df.select("id", "source").write.format("keyfold_bulk").option("transport", "pkg.module:factory")``

The factory is called in each task with the options and returns an object with
``send(rows) -> list``, where ``rows`` is a list of ``(id, source)`` and the result names the items the
store refused, as ids or ``(id, reason)``; ``close()``; and, if it wants the outcome on the driver, ``report(outcome)``.
``send`` raises :class:`Busy` to be called again later; any other error fails the task, and Spark
repeats it. Upserts by id make a repeated bulk harmless. :func:`register` sends this package to the
executors; a transport of your own goes there with ``--py-files``.
"""

from __future__ import annotations

import atexit
import importlib
import json
import shutil
import tempfile
import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamWriter,
    DataSourceWriter,
    WriterCommitMessage,
)

from keyfold.operators.deep_merge import STATE_SCHEMA, merge_rows, state_documents, update_documents
from keyfold.streaming.jobs import OUTCOME_SCHEMA, JobTables, Written

# The default flush and retry policy.
MAX_ROWS = 1_000
MAX_BYTES = 5 * 1024 * 1024
RETRIES = 3
BACKOFF_MS = 100


class Busy(Exception):
    """The store asks to try again later."""


@dataclass
class BulkOutcome(WriterCommitMessage):
    """What one task wrote."""

    rows: int = 0
    bytes: int = 0
    bulks: int = 0
    failed: int = 0
    ms: int = 0


def _transport(options: dict):
    module, _, factory = options["transport"].partition(":")
    return getattr(importlib.import_module(module), factory)(options)


class _Bulks:
    """Cuts a task's rows into bulks and sends them one at a time."""

    def __init__(self, options: dict):
        self.options = dict(options)
        self.max_rows = int(options.get("max_rows", MAX_ROWS))
        self.max_bytes = int(options.get("max_bytes", MAX_BYTES))
        self.retries = int(options.get("retries", RETRIES))
        self.backoff_ms = int(options.get("backoff_ms", BACKOFF_MS))

    def write(self, iterator: Iterator, refusals: list | None = None) -> BulkOutcome:
        """Sends the rows; ``refusals`` collects ``(id, reason)`` of the items the store did not take."""
        transport = _transport(self.options)
        outcome = BulkOutcome()
        self.refusals = refusals
        bulk, size = [], 0
        try:
            for row in iterator:
                bulk.append((row["id"], row["source"]))
                size += len(row["source"].encode())
                if len(bulk) >= self.max_rows or size >= self.max_bytes:
                    self._send(transport, bulk, size, outcome)
                    bulk, size = [], 0
            if bulk:
                self._send(transport, bulk, size, outcome)
        finally:
            transport.close()
        return outcome

    def _send(self, transport, bulk: list, size: int, outcome: BulkOutcome) -> None:
        started = time.monotonic()
        for attempt in range(self.retries + 1):
            try:
                refused = transport.send(bulk)
                break
            except Busy:
                if attempt == self.retries:
                    raise
                time.sleep(self.backoff_ms * 2**attempt / 1000)
        outcome.rows += len(bulk)
        outcome.bytes += size
        outcome.bulks += 1
        outcome.failed += len(refused)
        if self.refusals is not None:
            self.refusals += [(r, None) if isinstance(r, str) else tuple(r) for r in refused]
        outcome.ms += int((time.monotonic() - started) * 1000)

    def report(self, messages: list[BulkOutcome | None], batch_id: int | None) -> None:
        transport = _transport(self.options)
        try:
            if hasattr(transport, "report"):
                done = [m for m in messages if m is not None]
                total = {name: sum(getattr(m, name) for m in done) for name in ("rows", "bytes", "bulks", "failed", "ms")}
                transport.report({"batch_id": batch_id, **total})
        finally:
            transport.close()


class BulkWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.bulks = _Bulks(options)

    def write(self, iterator):
        return self.bulks.write(iterator)

    def commit(self, messages):
        self.bulks.report(messages, None)

    def abort(self, messages):
        """Nothing to undo: what was sent is sent again by the next attempt."""


class BulkStreamWriter(DataSourceStreamWriter):
    def __init__(self, options: dict):
        self.bulks = _Bulks(options)

    def write(self, iterator):
        return self.bulks.write(iterator)

    def commit(self, messages, batchId):  # noqa: N803 - Spark's name
        self.bulks.report(messages, batchId)

    def abort(self, messages, batchId):  # noqa: N803
        """Nothing to undo, see :class:`BulkWriter`."""


class BulkDataSource(DataSource):
    @classmethod
    def name(cls):
        return "keyfold_bulk"

    def schema(self):
        return "id string, source string"

    def writer(self, schema, overwrite):
        return BulkWriter(self.options)

    def streamWriter(self, schema, overwrite):  # noqa: N802 - Spark's name
        return BulkStreamWriter(self.options)


_SHIPPED: set[str] = set()


def register(spark: SparkSession) -> None:
    """Makes the writer known to a session, and this package to its executors."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        _SHIPPED.add(application)
        folder = tempfile.mkdtemp()  # executors may fetch the archive as long as the driver lives
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sources = Path(__file__).resolve().parents[2]
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/keyfold", "zip", sources, "keyfold"))
    spark.dataSource.register(BulkDataSource)


class FileTransport:
    """Bulks as JSON-lines files below ``path``, a folder or URI that all executors reach.

    Files are named by batch, task and bulk, so a task or batch that is repeated writes the same files again.
    """

    def __init__(self, options: dict):
        uri = options["path"]
        if uri.startswith("file:"):
            uri = "/" + uri.removeprefix("file:").lstrip("/")
        self.files, self.path = fs.FileSystem.from_uri(uri)
        self.files.create_dir(self.path)
        task = TaskContext.get()
        batch = options.get("batch") or (task and task.getLocalProperty("streaming.sql.batchId")) or "0"
        self.name = f"{batch}-{task.partitionId() if task else 'driver'}"
        self.bulks = 0

    def send(self, rows: list[tuple[str, str]]) -> list:
        self._put("bulk", [f'{{"id":{json.dumps(doc_id)},"doc":{source}}}' for doc_id, source in rows])
        return []

    def report(self, outcome: dict) -> None:
        self._put("outcome", [json.dumps(outcome)])

    def close(self) -> None:
        pass

    def _put(self, kind: str, lines: list[str]) -> None:
        target = f"{self.path}/{kind}-{self.name}-{self.bulks}.jsonl"
        self.bulks += 1
        with self.files.open_output_stream(target + ".part") as out:
            out.write("".join(line + "\n" for line in lines).encode())
        self.files.move(target + ".part", target)


class bulk_sink:  # noqa: N801 - used like a function
    """A document sink for :class:`jobs.JobConfig`: each batch as partial updates of its documents.

    The updates come from the change rows the store has written. All updates of an id go through one task, in
    order. Refused items stand in the outcome table with their reasons, beside one row of totals a task;
    a repeated batch replaces them.
    """

    def __init__(self, options: dict[str, str], name: str = "bulk"):
        self.options = dict(options)
        self.name = name

    def __call__(self, written: Written) -> int:
        return self.sent(written, written.changes()).count()

    def sent(self, written: Written, changes: DataFrame) -> DataFrame:
        """Sends change rows as updates; ``id, reason`` of what the store refused."""
        options = {**self.options, "batch": f"{written.run}-{written.batch_id}"}
        name = self.name

        def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            refusals: list = []
            rows = (row for frame in frames for row in frame.to_dict("records"))
            done = _Bulks(options).write(rows, refusals)
            task = TaskContext.get().partitionId()
            out = [(name, task, None, None, done.rows, done.bytes, done.bulks, done.ms)]
            out += [(name, task, doc_id, reason, 0, 0, 0, 0) for doc_id, reason in refusals]
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in OUTCOME_SCHEMA.split(", ")])

        updates = update_documents(changes, written.tables.store.order)
        ordered = updates.repartition("id").sortWithinPartitions("id", "step").select("id", "source")
        outcome = written.tables.outcome
        # a folder for each sink of the batch
        run = f"{written.run}-{name}"
        outcome.write(ordered.mapInPandas(send, OUTCOME_SCHEMA), written.batch_id, run)
        return outcome.read_batch(written.batch_id, run).filter(F.col("id").isNotNull()).select("id", "reason")


class retrying_sink(bulk_sink):  # noqa: N801
    """A :class:`bulk_sink` that sends refused items again (K2).

    What the store refused waits as change rows, with the number of attempts and the time of the next. Each batch merges what is due, and what it
    touches anyway, with its own changes, so an item is always sent as it is by then and never falls behind a later update; the wait
    doubles from ``backoff_seconds``. After ``limit`` attempts an item goes to the ``dead`` table as a document, with the last reason.
    Waiting rows are a snapshot a batch, the newest counts; a batch that is repeated starts from the one before it. Items
    that wait when no batch follows are sent by :meth:`drain`.
    """

    def __init__(self, options: dict[str, str], name: str = "bulk", limit: int = 5, backoff_seconds: float = 60.0):
        super().__init__(options, name)
        self.limit = limit
        self.backoff_seconds = backoff_seconds

    def __call__(self, written: Written) -> int:
        return self._retried(written, written.changes())

    def drain(self, tables: JobTables, run: str = "drain") -> int:
        """Sends what is due without a batch; the number of refused items."""
        batches = [b for r, b in tables.waiting.folders().batches() if r == f"{run}-{self.name}"]
        nothing = tables.spark.createDataFrame([], STATE_SCHEMA)
        return self._retried(Written(tables, run, max(batches, default=-1) + 1), nothing)

    def _waiting(self, written: Written) -> DataFrame:
        """The newest snapshot before this batch, of whatever run."""
        table, own = written.tables.waiting, f"{written.run}-{self.name}"
        last: dict[str, int] = {}
        for run, batch_id in table.folders().batches():
            if run.endswith(f"-{self.name}") and (run != own or batch_id < written.batch_id):
                last[run] = max(batch_id, last.get(run, -1))
        rows = table.read(list(last.items()))
        newest = rows.groupBy("run").agg(F.max("at").alias("at")).orderBy(F.col("at").desc()).first() if last else None
        rows = rows.filter(F.col("run") == newest["run"]) if newest else rows.limit(0)
        return rows.filter("id IS NOT NULL").drop("run", "batch_id", "at")

    def _retried(self, written: Written, changes: DataFrame) -> int:
        tables, order, run = written.tables, written.tables.store.order, f"{written.run}-{self.name}"
        before, now = self._waiting(written), datetime.now(timezone.utc)
        touched = changes.select("id").distinct().withColumn("touched", F.lit(True))
        marked = before.join(touched, "id", "left")
        ready = F.coalesce("touched", F.lit(False)) | (F.col("due") <= F.lit(now))
        again, rest = marked.filter(ready), marked.filter(~ready)
        whole = merge_rows(changes.unionByName(again.select(*changes.columns)), order)
        refused = self.sent(written, whole)
        tried = again.groupBy("id").agg(F.max("attempts").alias("tried"))
        failed = refused.groupBy("id").agg(F.max("reason").alias("reason")).join(tried, "id", "left")
        failed = failed.withColumn("attempts", F.coalesce("tried", F.lit(0)) + 1).drop("tried")
        wait = F.make_dt_interval(secs=self.backoff_seconds * F.pow(F.lit(2.0), F.col("attempts") - 1))
        left = whole.join(failed.filter(F.col("attempts") < self.limit), "id").withColumn("due", F.lit(now) + wait)
        kept = left.unionByName(rest.drop("touched")).withColumn("at", F.lit(now))
        # a row that says when, also where nothing waits
        stamp = tables.spark.createDataFrame([(now,)], "at timestamp")
        tables.waiting.write(kept.unionByName(stamp, allowMissingColumns=True), written.batch_id, run)
        dead = failed.filter(F.col("attempts") >= self.limit)
        lost = whole.join(dead.select("id"), "id", "left_semi")
        tables.dead.write(
            state_documents(lost, order).join(dead, "id").withColumn("sink", F.lit(self.name)), written.batch_id, run
        )
        return refused.count()
