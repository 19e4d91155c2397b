"""Output tables of the jobs: one folder per run and micro-batch, so a repeated batch replaces itself.

A run is the life of one checkpoint. Batch numbers begin at 0 again in a new one, so folders of two runs never
have the same name, and nothing compares the numbers of two runs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.deep_merge import (
    STATE_SCHEMA,
    drop_overwritten,
    merge_rows,
    state_documents,
    state_fields,
    state_rows,
)
from keyfold.operators.lookup import DEFAULT_FIELDS, point_get
from keyfold.operators.merge import TIME_ORDER

QUEUE_SCHEMA = "queue_name string, payload string, topic string, part int, pos bigint, ts timestamp"
QUARANTINE_SCHEMA = "topic string, part int, pos bigint, ts timestamp, value string, branch string, reason string"
METRICS_SCHEMA = (
    "messages bigint, bytes bigint, documents bigint, signals bigint, rejected bigint, failed bigint, "
    "sinks array<string>, ms bigint"
)
# Writes outside of any stream belong to this run.
DIRECT = "direct"
_MANIFEST_SCHEMA = "name string, buckets int, run string, upto bigint, writes map<bigint, string>"


class Folders:
    """The folders of a path, through Spark's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._files = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[tuple[str, int]]:
        """``(run, batch_id)`` of every folder."""
        found = self._files.globStatus(self._path(f"{self.path}/run=*/batch_id=*")) or []
        names = [(s.getPath().getParent().getName(), s.getPath().getName()) for s in found]
        return sorted((run.removeprefix("run="), int(batch.removeprefix("batch_id="))) for run, batch in names)

    def writes(self) -> dict[tuple[str, int], str]:
        """``(run, batch_id)`` of every folder and a name of the write that filled it: Spark's file names have one for each."""
        found = self._files.globStatus(self._path(f"{self.path}/run=*/batch_id=*/part-*")) or []
        out: dict[tuple[str, int], str] = {}
        for status in found:
            file = status.getPath()
            batch, run = file.getParent().getName(), file.getParent().getParent().getName()
            key = run.removeprefix("run="), int(batch.removeprefix("batch_id="))
            out[key] = max(out.get(key, ""), file.getName().split("-", 2)[2])
        return out

    def delete(self, name: str) -> None:
        self._files.delete(self._path(f"{self.path}/{name}"), True)


class BatchTable:
    """Parquet folder partitioned by ``run`` and ``batch_id``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def folder(self, batch_id: int, run: str = DIRECT) -> str:
        return f"run={run}/batch_id={batch_id}"

    def write(self, rows: DataFrame, batch_id: int, run: str = DIRECT) -> None:
        rows.drop("run", "batch_id").write.mode("overwrite").parquet(f"{self.path}/{self.folder(batch_id, run)}")

    def read(self, batches: list[tuple[str, int]] | None = None) -> DataFrame:
        """All rows, or those of some batches, of which alone the files are listed."""
        schema = f"{self.schema}, run string, batch_id bigint"
        if batches is None:
            return _read(self.spark, schema, self.path)
        if not batches:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{self.folder(batch, run)}" for run, batch in batches]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)

    def read_batch(self, batch_id: int, run: str = DIRECT) -> DataFrame:
        """The rows of one batch that was written."""
        return self.read([(run, batch_id)])

    def folders(self) -> Folders:
        return Folders(self.spark, self.path)


def _read(spark: SparkSession, schema: str, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Snapshot:
    """An entry of the manifest: a folder of merged rows, of each run the last batch folded into it, and the writes that were
    there to fold. A folder that was written again since is none of them, whatever its number."""

    def __init__(self, rows: list):
        self.seq, self.name, self.buckets = rows[0].seq, rows[0].name, rows[0].buckets
        self.folded = {r.run: r.upto for r in rows if r.run is not None}
        self.writes = {(r.run, batch): write for r in rows for batch, write in (r.writes or {}).items()}

    def holds(self, batch: tuple[str, int], write: str) -> bool:
        return self.writes.get(batch) == write


class DocumentStore:
    """Keyed document table (K1): change rows per batch, folded into a snapshot now and then.

    The snapshot is bucketed by ``id``. Folding new changes in shuffles the changes only: the union
    of both sides keeps the bucketing, and merging, pruning and rendering need nothing else. Rows are
    merged by the order their messages have, never by batch numbers, so it does not matter which run wrote
    them or how often.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        order: tuple[str, ...] = TIME_ORDER,
        null_policy: str = "overwrite",
        nested: bool = True,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.order = order
        self.null_policy = null_policy
        self.nested = nested
        self.changes = BatchTable(spark, f"{self.root}/changes", STATE_SCHEMA)

    def write_batch(self, docs: DataFrame, batch_id: int, run: str = DIRECT) -> None:
        self.write_rows(state_rows(docs, self.null_policy, self.order, self.nested), batch_id, run)

    def write_rows(self, rows: DataFrame, batch_id: int, run: str = DIRECT) -> None:
        """Stores the merged state rows of one batch."""
        self.changes.write(rows, batch_id, run)

    def state(self, upto: Mapping[str, int] | None = None, where: Column | None = None) -> DataFrame:
        """Merged state rows of everything written, or of each run as of a batch. ``where`` is a condition on
        ``id``; it reaches both scans, and on the snapshot picks the bucket."""
        written = self._written(upto)
        newest = next((s for s in self._snapshots() if _within(s.folded, upto)), None)

        def chosen(rows: DataFrame) -> DataFrame:
            return rows if where is None else rows.filter(where)

        if newest is None:
            return merge_rows(chosen(self.changes.read(list(written)).drop("run", "batch_id")), self.order)
        live = self.changes.read([b for b, write in written.items() if not newest.holds(b, write)]).drop("run", "batch_id")
        snapshot = chosen(self._snapshot_table(newest))
        return merge_rows(snapshot.unionByName(chosen(live).repartition(newest.buckets, "id")), self.order)

    def fields(self, upto: Mapping[str, int] | None = None) -> DataFrame:
        """``id, field, token`` of all documents."""
        return state_fields(self.state(upto), self.order)

    def documents(self, upto: Mapping[str, int] | None = None) -> DataFrame:
        """``id, source`` of all documents."""
        return state_documents(self.state(upto), self.order)

    def get(self, doc_id: str, names: tuple[str, ...] = DEFAULT_FIELDS) -> DataFrame:
        """``id, field, token`` of the named fields of one document (L1); one bucket of the snapshot is
        read."""
        return point_get(state_fields(self.state(where=F.col("id") == doc_id), self.order), doc_id, names)

    def compact(self, buckets: int = 1) -> bool:
        """Folds all batches into a new snapshot, visible once its entry is written; False when there is
        nothing to fold.

        ``buckets`` counts for the first snapshot; later ones keep its number, which is what saves
        the shuffle. Choose it so that a bucket of the final size fits a task.
        """
        snapshots, written = self._snapshots(), self._written(None)
        newest = snapshots[0] if snapshots else None
        if not [b for b, write in written.items() if newest is None or not newest.holds(b, write)]:
            return False
        if newest is None:
            merged = merge_rows(self.changes.read(list(written)).drop("run", "batch_id").repartition(buckets, "id"), self.order)
        else:
            buckets = newest.buckets
            merged = self.state()
        seq = newest.seq + 1 if newest else 0
        name = f"{seq}-{uuid.uuid4().hex[:8]}"
        (
            drop_overwritten(merged, self.order)
            .write.mode("overwrite")
            .bucketBy(buckets, "id")
            .sortBy("id")
            .option("path", f"{self.root}/snapshot/{name}")
            .saveAsTable(self._table_name(name))
        )
        folded = dict(newest.folded) if newest else {}
        for run, batch_id in written:
            folded[run] = max(batch_id, folded.get(run, -1))
        rows = [(name, buckets, run, upto, {b: w for (r, b), w in written.items() if r == run}) for run, upto in folded.items()]
        entry = self.spark.createDataFrame(rows, _MANIFEST_SCHEMA)
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/seq={seq}")
        return True

    def clean(self, keep: int = 2) -> None:
        """Removes all snapshots but the newest ``keep``, and the changes folded into the oldest of them. Who
        still reads an older snapshot has to begin anew, so keep as many as a read may last."""
        snapshots = self._snapshots()
        if len(snapshots) < keep:
            return
        manifest, tables, changes = (Folders(self.spark, f"{self.root}/{n}") for n in ("manifest", "snapshot", "changes"))
        for old in snapshots[keep:]:
            manifest.delete(f"seq={old.seq}")
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(old.name)}")
            tables.delete(old.name)
        for (run, batch_id), write in changes.writes().items():
            if snapshots[keep - 1].holds((run, batch_id), write):
                changes.delete(self.changes.folder(batch_id, run))

    def _written(self, upto: Mapping[str, int] | None) -> dict[tuple[str, int], str]:
        found = sorted(self.changes.folders().writes().items())
        return {b: write for b, write in found if upto is None or b[1] <= upto.get(b[0], -1)}

    def _snapshots(self) -> list[Snapshot]:
        """Newest first; the manifest has a row per snapshot and run."""
        schema = f"{_MANIFEST_SCHEMA}, seq bigint"
        rows: dict[int, list] = {}
        for row in _read(self.spark, schema, f"{self.root}/manifest").collect():
            rows.setdefault(row.seq, []).append(row)
        return [Snapshot(rows[seq]) for seq in sorted(rows, reverse=True)]

    def _table_name(self, name: str) -> str:
        store = hashlib.md5(self.root.encode()).hexdigest()[:12]
        return f"keyfold_{store}_{name.replace('-', '_')}"

    def _snapshot_table(self, snapshot: Snapshot) -> DataFrame:
        table = self._table_name(snapshot.name)
        # a session without a shared catalog has to be told about the files again
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({STATE_SCHEMA}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {snapshot.buckets} BUCKETS "
            f"LOCATION '{self.root}/snapshot/{snapshot.name}'"
        )
        return self.spark.table(table)


def _within(folded: Mapping[str, int], upto: Mapping[str, int] | None) -> bool:
    return upto is None or all(batch <= upto.get(run, -1) for run, batch in folded.items())
