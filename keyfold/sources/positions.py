"""A message log in Parquet files as a stream whose offsets are positions.

An offset is a map from partition to the next position to read, as for a broker's topic. So a stream starts where the ledger says, reads a
range again where it has to, takes up partitions that come into being, and reads no more than a number of positions of each
partition and batch, however much lies in wait in a hot one.

Where messages stand is known from the Parquet statistics of ``part`` and ``pos``; a task reads the row groups of one file
that reach into the batch. Files are read through Arrow's file systems. Of a partition, later files hold later positions; what
comes again, below the positions read so far, is left alone.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from keyfold.sources.message_log import MESSAGE_SCHEMA

FORMAT = "keyfold_positions"

# Executors need not have this package installed to run the reader.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Piece(InputPartition):
    """Row groups of a file, and the positions wanted of them: ``part`` to ``[start, end)``."""

    path: str
    groups: list[int]
    ranges: dict[int, tuple[int, int]]


@dataclass
class Group:
    """A row group, the partitions it may hold, and its positions."""

    number: int
    parts: tuple[int, int]
    positions: tuple[int, int]


class PositionReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.cap = int(options.get("positionspertrigger", 0))
        self.starting = {int(p): n for p, n in json.loads(options.get("starting", "{}")).items()}
        self.latest = options.get("policy", "earliest") == "latest"
        # how far a stream with this checkpoint has planned
        self.planned = {int(p): n for p, n in json.loads(options.get("resumed", "null") or "null").items()} if options.get("resumed") else None
        self.known: dict[str, tuple[list[Group], dict[int, int]]] = {}

    def _files(self) -> Iterator[tuple[str, list[Group], dict[int, int]]]:
        """Every file with its row groups and the position behind the last of each partition; a file is looked at once."""
        system, root = pyarrow.fs.FileSystem.from_uri(self.path) if "://" in self.path else (pyarrow.fs.LocalFileSystem(), self.path.removeprefix("file:"))
        found = system.get_file_info(pyarrow.fs.FileSelector(root, recursive=True, allow_not_found=True))
        for info in sorted(found, key=lambda f: f.path):
            if info.type != pyarrow.fs.FileType.File or not info.base_name.endswith(".parquet") or info.base_name.startswith(("_", ".")):
                continue
            if info.path not in self.known:
                with system.open_input_file(info.path) as opened:
                    self.known[info.path] = _looked_at(pq.ParquetFile(opened))
            yield info.path, *self.known[info.path]

    def _ends(self) -> dict[int, int]:
        ends: dict[int, int] = {}
        for _, _, last in self._files():
            for part, end in last.items():
                ends[part] = max(ends.get(part, 0), end)
        return ends

    def initialOffset(self) -> dict:
        start = self._ends() if self.latest else {part: 0 for part in self._ends()}
        return _text({**start, **self.starting})

    def latestOffset(self) -> dict:
        """No more than the cap beyond what was planned before, of each partition by itself."""
        ends = self._ends()
        if self.planned is None:
            self.planned = _numbers(self.initialOffset())
        for part, end in ends.items():
            start = self.planned.get(part, 0)
            self.planned[part] = max(start, min(end, start + self.cap) if self.cap else end)
        return _text(self.planned)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        begin, until = _numbers(start), _numbers(end)
        wanted = {part: (begin.get(part, 0), stop) for part, stop in until.items() if stop > begin.get(part, 0)}
        pieces = []
        for path, groups, _ in self._files():
            reached = [g for g in groups if any(g.parts[0] <= p <= g.parts[1] and g.positions[0] < b and a <= g.positions[1] for p, (a, b) in wanted.items())]
            if reached:
                pieces += [Piece(path, [g.number], wanted) for g in reached]
        # one piece at least, or Spark takes the batch for one without rows and columns
        return pieces or [Piece("", [], {})]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if not partition.groups:
            return
        system, root = pyarrow.fs.FileSystem.from_uri(self.path) if "://" in self.path else (pyarrow.fs.LocalFileSystem(), "")
        with system.open_input_file(partition.path) as opened:
            file = pq.ParquetFile(opened)
            for batch in file.iter_batches(row_groups=partition.groups, columns=["topic", "part", "pos", "ts", "value"]):
                inside = None
                for part, (start, end) in partition.ranges.items():
                    of = pc.and_(pc.equal(batch["part"], part), pc.and_(pc.greater_equal(batch["pos"], start), pc.less(batch["pos"], end)))
                    inside = of if inside is None else pc.or_(inside, of)
                rows = batch.filter(pc.fill_null(inside, False))
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [rows["topic"].cast(pa.string()), rows["part"].cast(pa.int32()), rows["pos"].cast(pa.int64()), rows["ts"].cast(pa.timestamp("us", tz="UTC")), rows["value"].cast(pa.string())],
                        names=["topic", "part", "pos", "ts", "value"],
                    )


class PositionSource(DataSource):
    """Options: ``path``; ``starting``, a JSON map of positions; ``policy`` of partitions it leaves out; ``positionsPerTrigger``, the cap of each
    partition; ``resumed``, how far the checkpoint got."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def streamReader(self, schema) -> PositionReader:
        return PositionReader({k.lower(): v for k, v in self.options.items()})


def _looked_at(file: pq.ParquetFile) -> tuple[list[Group], dict[int, int]]:
    """The row groups of a file by their statistics, and the position behind the last of each of its partitions. A group that holds one
    partition says so by itself; of others the two columns are read."""
    names = [file.schema_arrow.names.index(c) for c in ("part", "pos")]
    groups, ends = [], {}
    for number in range(file.metadata.num_row_groups):
        group = file.metadata.row_group(number)
        part, pos = (_statistics(group, file.schema_arrow.names[i]) for i in names)
        if group.num_rows == 0:
            continue
        if part is None or pos is None or part[0] != part[1]:
            table = file.read_row_group(number, columns=["part", "pos"])
            last = table.group_by("part").aggregate([("pos", "max")]).to_pydict()
            for p, n in zip(last["part"], last["pos_max"]):
                if p is not None and n is not None:
                    ends[p] = max(ends.get(p, 0), n + 1)
            part = part or (pc.min(table["part"]).as_py(), pc.max(table["part"]).as_py())
            pos = pos or (pc.min(table["pos"]).as_py(), pc.max(table["pos"]).as_py())
        else:
            ends[part[0]] = max(ends.get(part[0], 0), pos[1] + 1)
        if part[0] is not None and pos[0] is not None:
            groups.append(Group(number, part, pos))
    return groups, ends


def _statistics(group, name: str) -> tuple[int, int] | None:
    for i in range(group.num_columns):
        column = group.column(i)
        if column.path_in_schema == name and column.statistics is not None and column.statistics.has_min_max:
            return column.statistics.min, column.statistics.max
    return None


def _text(offset: dict[int, int]) -> dict:
    return {str(part): offset[part] for part in sorted(offset)}


def _numbers(offset: dict) -> dict[int, int]:
    return {int(part): int(n) for part, n in offset.items()}


def checkpoint_positions(spark: SparkSession, checkpoint: str) -> dict[str, int] | None:
    """How far a checkpoint has planned, or None for a new one: the last entry of its list of offsets."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    files = folder.getFileSystem(hadoop)
    batches = [s.getPath() for s in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/*")) or [] if s.getPath().getName().isdigit()]
    if not batches:
        return None
    stream = files.open(max(batches, key=lambda p: int(p.getName())))
    try:
        lines = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode().splitlines()
    finally:
        stream.close()
    return json.loads(lines[-1])


def stream_positions(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    starting: dict[int, int] | None = None,
    policy: str = "earliest",
    positions_per_trigger: int | None = None,
) -> DataFrame:
    """The log in ``path`` as a stream. ``starting`` and ``policy`` count for a new checkpoint, an old one goes on where it was."""
    spark.dataSource.register(PositionSource)
    options = {"path": path, "starting": json.dumps(_text(starting or {})), "policy": policy}
    resumed = checkpoint_positions(spark, checkpoint)
    if resumed is not None:
        options["resumed"] = json.dumps(resumed)
    if positions_per_trigger:
        options["positionsPerTrigger"] = str(positions_per_trigger)
    return spark.readStream.format(FORMAT).options(**options).load()
