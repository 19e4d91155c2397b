"""A keyed document store in levels (K1): sorted runs per bucket, folded by size ratio, over buckets that split.

Change rows come in batches, level 0. Folding cuts them into buckets by ``id`` and writes one run, sorted inside its buckets. A
bucket with ``fan`` runs of a level gets them merged into one of the next, other buckets are left alone, so a row is written again
about as often as the logarithm of the number of batches says, and a change of one id writes the one bucket it is in.

Buckets are addressed as in linear hashing: below the pointer an id's bucket is its hash modulo twice the base, else modulo the base. When a
bucket holds ``bucket_rows`` rows on average, the bucket at the pointer is split; a full turn of the pointer doubles the base.

A run is a Parquet folder partitioned by bucket and bucketed by ``id`` with the modulus of its buckets, so all runs of one modulus are
merged as they lie, and only the changes not yet folded are shuffled. Which buckets of which runs count is said by the
commit log, one commit a fold.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.deep_merge import STATE_SCHEMA, drop_overwritten, merge_rows, state_documents, state_fields, state_rows
from keyfold.operators.lookup import DEFAULT_FIELDS, point_get
from keyfold.operators.merge import TIME_ORDER
from keyfold.streaming.commits import Changes, CommitLog, CommittedTable, State, Transaction, new_folder
from keyfold.streaming.tables import DIRECT

RUNS = "runs"


@dataclass(frozen=True)
class Buckets:
    """The address table: ``base`` buckets, of which those below ``pointer`` were split."""

    base: int
    pointer: int = 0

    @property
    def count(self) -> int:
        return self.base + self.pointer

    def split(self) -> Buckets:
        return Buckets(2 * self.base) if self.pointer + 1 == self.base else Buckets(self.base, self.pointer + 1)

    def moduli(self) -> list[int]:
        return [self.base] if not self.pointer else [self.base, 2 * self.base]

    def modulus_of(self, bucket: int) -> int:
        return 2 * self.base if bucket < self.pointer or bucket >= self.base else self.base

    def within(self, modulus: int) -> Column:
        """Whether an id is in a bucket of a modulus."""
        early = _bucket("id", self.base) < self.pointer
        return early if modulus == 2 * self.base and self.pointer else ~early if self.pointer else F.lit(True)


def _bucket(column: str, modulus: int) -> Column:
    """The bucket Spark's writer puts an id into."""
    return F.pmod(F.hash(column), F.lit(modulus))


@dataclass(frozen=True)
class Run:
    """One bucket of a run."""

    entry: str
    folder: str
    modulus: int
    bucket: int
    level: int
    rows: int


def _runs(state: State) -> list[Run]:
    return [
        Run(entry, entry.rsplit("/", 1)[0], p["modulus"], p["bucket"], p["level"], p["rows"]) for entry, p in state.entries(RUNS).items()
    ]


class LeveledStore:
    """Documents by ``id`` under ``log.root``; several writers may add batches, one at a time folds."""

    def __init__(
        self,
        log: CommitLog,
        order: tuple[str, ...] = TIME_ORDER,
        null_policy: str = "overwrite",
        nested: bool = True,
        buckets: int = 16,
        fan: int = 4,
        bucket_rows: int = 20_000_000,
        current: Callable[[], Transaction | None] = lambda: None,
    ):
        self.log = log
        self.spark: SparkSession = log.spark
        self.order = order
        self.null_policy = null_policy
        self.nested = nested
        self.first_buckets = buckets
        self.fan = fan
        self.bucket_rows = bucket_rows
        self.changes = CommittedTable(log, "changes", STATE_SCHEMA, current)

    def write(self, docs: DataFrame) -> None:
        """Merges documents in, at any time and without a number: what they say is visible at once."""
        self.write_batch(docs, 0)

    def write_batch(self, docs: DataFrame, batch_id: int, run: str = DIRECT) -> None:
        self.write_rows(state_rows(docs, self.null_policy, self.order, self.nested), batch_id, run)

    def write_rows(self, rows: DataFrame, batch_id: int = 0, run: str = DIRECT) -> None:
        self.changes.write(rows, batch_id, run)

    def buckets(self, state: State | None = None) -> Buckets:
        found = (state or self.log.state()).notes.get("buckets")
        return Buckets(*found) if found else Buckets(self.first_buckets)

    def state(self, version: int | None = None, ids: Iterable[str] | None = None) -> DataFrame:
        """Merged state rows of everything committed, or as of a version that is still kept. With ``ids``, a bounded list, only their
        buckets are read, and of these only row groups that may hold them."""
        return _union(self._parts(version, None if ids is None else sorted(set(ids))))

    def _parts(self, version: int | None = None, ids: list[str] | None = None) -> list[DataFrame]:
        """The state, a frame a modulus (two at most), whose partitions are buckets."""
        state = self.log.state(version)
        return [self._of_modulus(state, modulus, ids) for modulus in self.buckets(state).moduli()]

    def _of_modulus(self, state: State, modulus: int, ids: list[str] | None = None) -> DataFrame:
        buckets = self.buckets(state)
        near = None if ids is None else {h % modulus for h in self._hashes(ids)}
        found = []
        if state.entries("changes"):
            fresh = self.changes.read_folders(state.entries("changes")).drop("run", "batch_id")
            fresh = fresh.filter(buckets.within(modulus))
            found.append(fresh if ids is None else fresh.filter(F.col("id").isin(ids)))
            found[0] = found[0].withColumn("bucket", F.lit(-1)).repartition(modulus, "id")
        runs = [r for r in _runs(state) if r.modulus == modulus and (near is None or r.bucket in near)]
        for folder, live in _by_folder(runs).items():
            some = self._table(folder, modulus, live)
            found.append(some if ids is None else some.filter(F.col("id").isin(ids)))
        return merge_rows(_union(found) if found else self.spark.createDataFrame([], STATE_SCHEMA), self.order)

    def fields(self, version: int | None = None) -> DataFrame:
        """``id, field, token`` of all documents."""
        return _union(state_fields(part, self.order) for part in self._parts(version))

    def documents(self, version: int | None = None) -> DataFrame:
        """``id, source`` of all documents."""
        return _union(state_documents(part, self.order) for part in self._parts(version))

    def get(self, doc_id: str, names: tuple[str, ...] = DEFAULT_FIELDS) -> DataFrame:
        """``id, field, token`` of the named fields of one document (L1); one bucket is read."""
        return point_get(state_fields(self.state(ids=[doc_id]), self.order), doc_id, names)

    def get_many(self, ids: Iterable[str]) -> DataFrame:
        """``id, source`` of a bounded list of documents (L2): only their buckets are read."""
        return state_documents(self.state(ids=ids), self.order)

    def get_joined(self, ids: DataFrame) -> DataFrame:
        """``id, source`` of the documents whose ids ``ids`` has, however many: ids go to their buckets, and stored rows stay where they are."""
        wanted = ids.select("id").distinct()
        state = self.log.state()
        out = []
        for modulus in self.buckets(state).moduli():
            own = wanted.filter(self.buckets(state).within(modulus)).repartition(modulus, "id")
            found = self._of_modulus(state, modulus).join(own.hint("merge"), "id", "left_semi")
            out.append(state_documents(found, self.order))
        return _union(out)

    def fold(self, every: bool = False) -> bool:
        """Folds the batches into a run once there are ``fan`` of them, or ``every`` one; then merges levels that are full and splits
        buckets that are. False when there was nothing to do."""
        done = False
        state = self.log.state()
        if len(state.entries("changes")) >= (1 if every else self.fan):
            self._fold_changes(state)
            done = True
        while self._merge_level() or self._split():
            done = True
        return done

    def compact(self, buckets: int = 0) -> bool:
        """Folds every batch; the number of buckets takes care of itself."""
        return self.fold(every=True)

    def clean(self, keep: int = 2) -> None:
        """Deletes what the last ``keep`` versions of the log do not name."""
        for folder in {"/".join(f.split("/")[:2]) for f in self.log.clean(keep) if f.startswith(f"{RUNS}/")}:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(folder)}")

    def _fold_changes(self, state: State) -> None:
        buckets, changes = self.buckets(state), Changes()
        rows = self.changes.read_folders(state.entries("changes")).drop("run", "batch_id")
        for modulus in buckets.moduli():
            part = rows.filter(buckets.within(modulus)).repartition(modulus, "id")
            self._write(merge_rows(part, self.order), modulus, lambda _: 1, changes)
        changes.drop("changes", state.entries("changes"))
        changes.notes["buckets"] = [buckets.base, buckets.pointer]
        self.log.commit(changes)

    def _merge_level(self) -> bool:
        """Merges the runs of every bucket that has ``fan`` of one level, the lowest such level of each, one write a modulus."""
        state = self.log.state()
        groups: dict[tuple[int, int, int], list[Run]] = defaultdict(list)
        for run in _runs(state):
            groups[run.modulus, run.bucket, run.level].append(run)
        full: dict[int, dict[int, list[Run]]] = defaultdict(dict)
        for (modulus, bucket, _), runs in sorted(groups.items()):
            if len(runs) >= self.fan and bucket not in full[modulus]:
                full[modulus][bucket] = runs
        changes = Changes()
        for modulus, due in full.items():
            if due:
                self._merge([r for runs in due.values() for r in runs], modulus, modulus, lambda b, due=due: due[b][0].level + 1, changes)
        if not changes.remove:
            return False
        self.log.commit(changes)
        return True

    def _split(self) -> bool:
        """Splits buckets, the one at the pointer first, until the rest holds ``bucket_rows`` on average; as many at a time as one turn of
        the pointer allows."""
        state = self.log.state()
        buckets, runs = self.buckets(state), _runs(state)
        total = sum(r.rows for r in runs)
        due: list[int] = []
        after = buckets
        while total > self.bucket_rows * after.count and after.base == buckets.base:
            due.append(after.pointer)
            after = after.split()
        if not due:
            return False
        changes = Changes()
        mine = [r for r in runs if r.modulus == buckets.base and r.bucket in due]
        if mine:
            level = max(r.level for r in mine)
            self._merge(mine, buckets.base, 2 * buckets.base, lambda _: level, changes)
        changes.notes["buckets"] = [after.base, after.pointer]
        self.log.commit(changes)
        return True

    def _merge(self, runs: list[Run], modulus: int, to: int, level: Callable[[int], int], changes: Changes) -> None:
        """Rewrites buckets of runs as one run, with another modulus where they are split."""
        rows = _union(self._table(folder, modulus, live) for folder, live in _by_folder(runs).items())
        merged = drop_overwritten(merge_rows(rows, self.order), self.order)
        self._write(merged if to == modulus else merged.repartition(to, "id"), to, level, changes)
        changes.drop(RUNS, [r.entry for r in runs])

    def _write(self, rows: DataFrame, modulus: int, level: Callable[[int], int], changes: Changes) -> None:
        """Writes rows, a partition a bucket, as a run."""
        folder = new_folder(RUNS)
        table = self._name(folder)
        (
            rows.withColumn("bucket", _bucket("id", modulus))
            .write.mode("overwrite")
            .partitionBy("bucket")
            .bucketBy(modulus, "id")
            .sortBy("id")
            .option("path", f"{self.log.root}/{folder}")
            .option("parquet.bloom.filter.enabled#id", "true")
            .saveAsTable(table)
        )
        counts = self.spark.read.schema("bucket int").option("basePath", f"{self.log.root}/{folder}").parquet(f"{self.log.root}/{folder}")
        for bucket, n in counts.groupBy("bucket").count().collect():
            changes.put(RUNS, f"{folder}/bucket={bucket}", modulus=modulus, bucket=bucket, level=level(bucket), rows=n)

    def _name(self, folder: str) -> str:
        return f"keyfold_{hashlib.md5(f'{self.log.root}/{folder}'.encode()).hexdigest()}"

    def _table(self, folder: str, modulus: int, live: list[int]) -> DataFrame:
        """Some buckets of a run, with their partitioning."""
        table = self._name(folder)
        if not self.spark.catalog.tableExists(table):
            # written by another session
            self.spark.sql(
                f"CREATE TABLE {table} ({STATE_SCHEMA}, bucket int) USING parquet PARTITIONED BY (bucket) "
                f"CLUSTERED BY (id) SORTED BY (id) INTO {modulus} BUCKETS LOCATION '{self.log.root}/{folder}'"
            )
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        # the column stays: a union of frames that dropped it loses their partitioning
        return self.spark.table(table).filter(F.col("bucket").isin(live))

    def _hashes(self, ids: list[str]) -> list[int]:
        rows = self.spark.createDataFrame([(i,) for i in ids], "id string").select(F.hash("id"))
        return [r[0] for r in rows.collect()]


def _by_folder(runs: list[Run]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = defaultdict(list)
    for run in runs:
        out[run.folder].append(run.bucket)
    return dict(sorted(out.items()))


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    out = None
    for frame in frames:
        out = frame if out is None else out.unionByName(frame)
    assert out is not None
    return out
