"""Keys that stand in more than one place, found with one shuffle and without a hot task.

Rows are ``k1, k2`` (a 96-bit key), ``doc, part, more`` (a row of the table) and ``mark`` (a place and a kind). Rows of
a batch that share a key are settled on the spot; they travel on under a scattered key, and one stand-in
tells the other batches. So a key sends one row a batch, however many places hold it. Behind the shuffle the
rows of a key are next to each other and are read as a stream: no group is ever held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from keyfold.llm.common import encoded_slices, id_order, scramble, stored

PROBE, SETTLED, STAND_IN = 0, 1, 2

ROWS = StructType(
    [
        StructField("k1", LongType(), False),
        StructField("k2", IntegerType(), False),
        StructField("doc", LongType(), False),
        StructField("part", LongType(), False),
        StructField("more", LongType(), False),
        StructField("mark", LongType(), False),
    ]
)
PLACES = StructType(
    [StructField(c, LongType(), False) for c in ("doc", "part", "more", "place")]
)
#: The columns a row is known by, and the two after ``doc`` as one value of numpy's.
NAME = ["doc", "part", "more"]
PART = np.dtype([("part", "<i8"), ("more", "<i8")])
# Slots in which ids are counted that several rows share.
SLOTS = 1 << 20


def text_name(text: F.Column) -> dict[str, F.Column]:
    """128 bits of a text that tell rows without an id of their own apart."""
    return {"part": F.xxhash64(text), "more": F.xxhash64(F.lit("more"), text)}


def identified(docs: DataFrame, number: F.Column | None = None) -> DataFrame:
    """``doc, part, more, doc_id, text``, and ``number`` as ``row``. A row is known by its integral ``doc_id`` (null stands behind all
    others) and 128 bits of its text, so it keeps its name whatever reads it again."""
    text = F.coalesce("text", F.lit(""))
    names = [c.alias(name) for name, c in text_name(text).items()]
    more = [] if number is None else [number.alias("row")]
    return docs.select(id_order(F.col("doc_id")).alias("doc"), *names, "doc_id", text.alias("text"), *more)


def shortly_identified(docs: DataFrame) -> DataFrame:
    """As :func:`identified`, but rows that have an id to themselves have no bits of their text, which saves them in every shuffle.

    Ids that several rows share are found by slots of their hash, ``SLOTS`` at most, so what is broadcast is bounded; an id that
    shares a slot with such a one keeps its bits for nothing.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    shared = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    slots = stored(shared.select(slot.alias("slot")).distinct(), "slots")
    rows = identified(docs).withColumn("slot", slot)
    if slots.isEmpty():
        marked = rows.withColumn("alone", F.col("doc_id").isNotNull())
    else:
        marked = rows.join(F.broadcast(slots.withColumn("twice", F.lit(True))), "slot", "left")
        marked = marked.withColumn("alone", F.col("doc_id").isNotNull() & F.col("twice").isNull())
    names = [F.when(F.col("alone"), F.lit(0)).otherwise(F.col(c)).cast("bigint").alias(c) for c in NAME[1:]]
    return marked.select("doc", *names, "doc_id", "text")


def names_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``doc`` and :data:`PART` of the rows of a batch."""
    part = np.empty(batch.num_rows, PART)
    for c in NAME[1:]:
        part[c] = batch.column(c).to_numpy()
    return batch.column("doc").to_numpy(), part


def named(doc: np.ndarray, part: np.ndarray) -> list[pa.Array]:
    """The columns ``doc, part, more``."""
    return [pa.array(doc), *(pa.array(np.ascontiguousarray(part[c])) for c in NAME[1:])]


def packed(rows: DataFrame) -> DataFrame:
    """The rows of :func:`identified` with the texts compressed, for shuffles."""
    schema = StructType(
        [*PLACES.fields[:3], rows.schema["doc_id"], *StructType.fromDDL("packed binary").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [small.compress(t) for _, some in encoded_slices(batch.column("text")) for t in some]
            columns = [batch.column(c) for c in (*NAME, "doc_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def unpacked(column: pa.Array) -> list[bytes]:
    large = zstandard.ZstdDecompressor()
    return [large.decompress(x) for x in column.to_pylist()]


def probes(
    k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, part: np.ndarray, place: np.ndarray, later: bool
) -> pa.RecordBatch:
    """The rows one batch sends. ``later``: a place counts when a smaller ``doc`` holds its key too, else when
    any other place does."""
    order = np.lexsort((doc, k2, k1))
    k1, k2, doc, part, place = (a[order] for a in (k1, k2, doc, part, place))
    new = np.ones(len(k1), dtype=bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    if later:
        settled = doc > doc[first][group]
        stand_in = np.zeros(0, dtype=np.int64)
    else:
        sizes = np.diff(np.append(first, len(k1)))
        settled = (sizes > 1)[group]
        stand_in = first[sizes > 1]
    mark = place << 2
    mark[settled] |= SETTLED
    key = k1.view(np.int64).copy()
    key[settled] = scramble(doc[settled].view(np.uint64) ^ scramble(place[settled].view(np.uint64))).view(np.int64)
    second = k2.astype(np.uint32).view(np.int32).copy()
    second[settled] = 0

    def and_stand_ins(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.concatenate((a, b))

    return pa.RecordBatch.from_arrays(
        [
            pa.array(and_stand_ins(key, k1[stand_in].view(np.int64))),
            pa.array(and_stand_ins(second, k2[stand_in].astype(np.uint32).view(np.int32))),
            *named(and_stand_ins(doc, doc[stand_in]), and_stand_ins(part, part[stand_in])),
            pa.array(and_stand_ins(mark, np.full(len(stand_in), STAND_IN, np.int64))),
        ],
        names=ROWS.names,
    )


def meet(rows: DataFrame, later: bool) -> DataFrame:
    """``doc, part, more, place`` of every place whose key stands elsewhere, as :func:`probes` says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first_doc = waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, mark = (batch.column(c).to_numpy() for c in ("k1", "k2", "mark"))
            doc, part = names_of(batch)
            kind = mark & 3
            found = kind == SETTLED
            at = np.flatnonzero(~found)
            early = None
            if len(at):
                new = np.ones(len(at), dtype=bool)
                new[1:] = (k1[at[1:]] != k1[at[:-1]]) | (k2[at[1:]] != k2[at[:-1]])
                first = np.flatnonzero(new)
                group = np.cumsum(new) - 1
                goes_on = key == (k1[at[0]], k2[at[0]])
                if later:
                    smallest = doc[at[first]]
                    if goes_on:
                        smallest[0] = first_doc
                    found[at] = doc[at] > smallest[group]
                    first_doc = smallest[-1]
                else:
                    several = np.diff(np.append(first, len(at))) > 1
                    if goes_on:
                        several[0], early = True, waiting
                    found[at] = several[group] & (kind[at] == PROBE)
                    # a key met once so far may go on in the next batch
                    last = at[-1]
                    alone = not several[-1] and kind[last] == PROBE
                    waiting = (doc[last], part[last], mark[last] >> 2) if alone else None
                key = (k1[at[-1]], k2[at[-1]])
            columns = [doc[found], part[found], mark[found] >> 2]
            if early is not None:
                columns = [np.append(c, np.array([e], c.dtype)) for c, e in zip(columns, early)]
            yield pa.RecordBatch.from_arrays([*named(*columns[:2]), pa.array(columns[2])], names=PLACES.names)

    together = rows.repartition("k1").sortWithinPartitions("k1", "k2", "doc")
    return together.mapInArrow(run, PLACES)


def by_row(places: DataFrame, name: str) -> DataFrame:
    """``doc, part, more`` and the places of each, as many as its text holds at most."""
    return places.groupBy(*NAME).agg(F.collect_set("place").alias(name))


def concatenated(lists: list, dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """The entries of some lists (null is empty) in a row, and how many each has."""
    sizes = np.array([0 if x is None else len(x) for x in lists], np.int64)
    flat = [i for x in lists if x is not None for i in x]
    return np.array(flat, dtype), sizes
