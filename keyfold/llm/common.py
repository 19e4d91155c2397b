"""What the operators share: the input table, stored intermediates, slices of batches, hashed words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyfold.session import scratch_path

# The characters that separate words in all contracts, [\x20\x09-\x0D].
WHITESPACE = " \t\n\x0b\f\r"
# Text handled at once inside a task; it bounds the arrays built over it, whatever the batch.
SLICE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(c) for c in WHITESPACE]] = True
#: A random number for each byte value, the same in every process.
BYTE_HASH = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)


# What Spark hands to Python at once. Its own limit lets two tasks fill an executor's memory beside the heap.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Lowers the size of Arrow batches for the session, unless the cluster names one; it changes no result."""
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Writes ``rows`` to the shared scratch folder and reads them again: cuts the lineage, and a lost
    executor costs nothing that was written."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def schema_with(rows: DataFrame, columns: list[str], more: str) -> StructType:
    """The schema of some columns of ``rows`` followed by the columns of a DDL string."""
    return StructType([*(rows.schema[c] for c in columns), *StructType.fromDDL(more).fields])


def row_number() -> F.Column:
    """A number for each row; it holds once it is stored, for another scan may number otherwise."""
    return F.monotonically_increasing_id()


def id_order(doc_id: F.Column) -> F.Column:
    """An integral ``doc_id`` that is never null; null stands behind all others."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(2**63 - 1))


def first_rows(docs: DataFrame, key: dict[str, F.Column], wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is among ``wanted``, which has columns of its names and no nulls: one row of each
    key, the longest text first. All columns stay as they are. The window needs no shuffle of its own."""
    text = F.char_length(F.coalesce("text", F.lit("")))
    whole = docs.select(
        F.struct(*docs.columns).alias("kept"), text.alias("size"), *(c.alias(name) for name, c in key.items())
    )
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("size").desc()))
    found = whole.join(wanted, list(key), "left_semi").withColumn("place", place)
    return found.filter("place = 1").select("kept.*")


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with about ``limit`` bytes each; a larger row stands alone."""
    ends = np.cumsum(sizes)
    start, done = 0, 0
    while start < len(ends):
        end = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, end
        start, done = end, int(ends[end - 1])


def encoded(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def encoded_slices(column: pa.Array, limit: int = SLICE_BYTES, row_bytes: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a column as :func:`encoded`, some rows at a time, and the number of the first: a batch
    may hold many texts, and Python's copies take more room than the batch. ``row_bytes`` is what a row counts besides its text."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for start, end in slices(sizes + row_bytes, limit):
        yield start, encoded(column.slice(start, end - start))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes; the order within a pair counts."""
    out = a * np.uint64(0xFF51AFD7ED558CCD)
    out += (b ^ (b >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(32)
    return out


def scramble(a: np.ndarray) -> np.ndarray:
    """A second, independent-looking hash of a hash."""
    out = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def ahead(a: np.ndarray, by: int) -> np.ndarray:
    """``a`` moved ``by`` places to the left, filled up with zeros."""
    out = np.zeros_like(a)
    if by < len(a):
        out[: len(a) - by] = a[by:]
    return out


def powers(ids: np.ndarray, upto: int) -> dict[int, np.ndarray]:
    """Identifiers of the runs of 1, 2, 4, ... places from each place on. A run's identifier is made of those of its
    halves, the later half being looked up at its offset: every level reuses the one below."""
    levels, size = {1: ids}, 1
    while 2 * size <= upto:
        levels[2 * size] = mix(levels[size], ahead(levels[size], size))
        size *= 2
    return levels


def span_ids(levels: dict[int, np.ndarray], start: np.ndarray, length: np.ndarray, power: int) -> np.ndarray:
    """Identifiers of the runs at ``start``, ``power`` to less than twice as long: two runs of ``power`` that
    overlap cover one."""
    wide = levels[power]
    return mix(wide[start], wide[start + length - power] + length.astype(np.uint64))


def run_ids(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Identifiers of the runs of each length in ``lengths`` that start at each place."""
    levels = powers(ids, max(lengths))
    out = {}
    for length in lengths:
        power = 1 << (length.bit_length() - 1)
        if power == length:
            out[length] = levels[power]
        else:
            out[length] = mix(levels[power], ahead(levels[power], length - power) + np.uint64(length))
    return out


def least_ahead(ids: np.ndarray, span: int) -> np.ndarray:
    """For each place, which of the ``span`` places from it on has the smallest identifier, the first of
    equals. What is decided so depends on these places alone, not on where they stand."""
    bits = max(1, int(len(ids)).bit_length())
    low = np.uint64((1 << bits) - 1)
    least, size = (ids & ~low) | np.arange(len(ids), dtype=np.uint64), 1
    while 2 * size <= span:
        least = np.minimum(least, _filled_ahead(least, size))
        size *= 2
    return (np.minimum(least, _filled_ahead(least, span - size)) & low).astype(np.int64)


def _filled_ahead(a: np.ndarray, by: int) -> np.ndarray:
    """As :func:`ahead`, filled up with what is larger than all else."""
    out = np.full_like(a, np.uint64(2**64 - 1))
    if by < len(a):
        out[: len(a) - by] = a[by:]
    return out


def count_up(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size, one after another."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Words:
    """The words of some texts: ``hashes``, byte ranges ``starts`` to ``ends`` in ``buffer``, and the
    ``text`` each belongs to; ``bounds[i]`` to ``bounds[i+1]`` are the words of text ``i``."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        space = _SPACE[self.buffer]
        # the last byte is a separator, so every word ends before it
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edges = np.concatenate(([0], edges))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.hashes = self._hashes()
        tops = np.cumsum([len(t) + 1 for t in texts])
        self.bounds = np.concatenate(([0], np.searchsorted(self.starts, tops)))
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def _hashes(self) -> np.ndarray:
        out = np.zeros(len(self.starts), dtype=np.uint64)
        if not len(out):
            return out
        lengths = self.ends - self.starts
        powers_ = np.full(int(lengths.max()), _MULTIPLIER, dtype=np.uint64)
        powers_[0] = 1
        powers_ = np.multiply.accumulate(powers_)
        # in steps, for the arrays below take sixteen times the bytes they are made of
        for first, last in slices(lengths):
            size = lengths[first:last]
            place = count_up(size)
            letters = BYTE_HASH[self.buffer[place + np.repeat(self.starts[first:last], size)]]
            letters *= powers_[place]
            out[first:last] = scramble(np.add.reduceat(letters, np.cumsum(size) - size) + size.astype(np.uint64))
        return out

    def to_end(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return self.bounds[1:][self.text] - np.arange(len(self.text))
