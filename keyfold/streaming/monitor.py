"""Progress of running jobs as a table (K4): a listener writes a row for every batch of every job it knows by name."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from keyfold.streaming.commits import CommittedTable
from keyfold.streaming.tables import BatchTable

PROGRESS_SCHEMA = (
    "name string, messages bigint, messages_per_second double, read_per_second double, lag bigint, ms bigint, "
    "get_ms bigint, plan_ms bigint, write_ms bigint, state_rows bigint, reached string"
)


class ProgressListener(StreamingQueryListener):
    """Writes progress to the table that ``table_of`` names for a query's name; None leaves the query out.

    ``lag`` is the number of positions between what a batch reached and what the source had, where the source says so. Progress is
    written by the listener's own thread, so a job never waits for it.
    """

    def __init__(self, table_of: Callable[[str | None], BatchTable | CommittedTable | None]):
        self.table_of = table_of
        self.spark = SparkSession.active()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        table = self.table_of(progress.name)
        # a trigger that found nothing reports too
        if table is None or "addBatch" not in progress.durationMs:
            return
        table.write(self.spark.createDataFrame([progress_row(progress)], PROGRESS_SCHEMA), progress.batchId, str(progress.id))


def progress_row(progress) -> tuple:
    took = progress.durationMs
    lags = [lag_of(s.endOffset, s.latestOffset) for s in progress.sources]
    known = [n for n in lags if n is not None]
    return (
        progress.name,
        progress.numInputRows,
        progress.processedRowsPerSecond,
        progress.inputRowsPerSecond,
        sum(known) if known else None,
        took.get("triggerExecution"),
        took.get("latestOffset"),
        took.get("queryPlanning"),
        took.get("addBatch"),
        sum(s.numRowsTotal for s in progress.stateOperators),
        progress.sources[0].endOffset if len(progress.sources) == 1 else None,
    )


def lag_of(reached: str | None, latest: str | None) -> int | None:
    """Positions between two offsets, maps from partition to position, within topics or not; None for other offsets."""
    ends = [_positions(text) for text in (reached, latest)]
    if None in ends:
        return None
    return sum(max(0, end - ends[0].get(key, 0)) for key, end in ends[1].items())


def _positions(text: str | None) -> dict | None:
    try:
        offset = json.loads(text or "null")
    except ValueError:
        return None
    if not isinstance(offset, dict) or not offset:
        return None
    if all(isinstance(n, int) for n in offset.values()):
        return offset
    if all(isinstance(parts, dict) and all(isinstance(n, int) for n in parts.values()) for parts in offset.values()):
        return {(topic, part): n for topic, parts in offset.items() for part, n in parts.items()}
    return None


def settled(spark: SparkSession) -> None:
    """Waits until listeners have heard of everything that happened so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
