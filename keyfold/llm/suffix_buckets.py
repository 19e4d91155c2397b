"""Suffix-array dedup (operator 7): repeated byte strings by winnowing and content cells.

This stands in for bucket-pointer refinement, whose sort of all suffixes would move a row for each byte of text in each round (the
README says more). Places are bucketed by hashes of what begins there, never by identifiers of a global sort; what is kept of the
refinement is that every round looks at what the one before left together, and that a place whose bucket holds nothing
else is done:

1. Each window of ``WINDOW`` bytes is looked up at one gram of its own, the one with the smallest identifier, the first of
   equals. Equal windows choose the same, so a window whose gram stands nowhere else is unique.
2. The windows of a gram are refined in cells of up to ``CELL`` neighbours, bucketed by the bytes that a cell's
   windows have in common. A cell alone in its bucket holds no repeated window. Cells of a bucket with
   all bytes equal stand elsewhere as a whole.
3. Where a bucket holds different cells, the windows of one cell of each kind are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from keyfold.llm.common import (
    BYTE_HASH,
    count_up,
    encoded_slices,
    least_ahead,
    powers,
    schema_with,
    scramble,
    slices,
    span_ids,
)
from keyfold.llm.meeting import (
    NAME,
    PART,
    PLACES,
    PROBE,
    ROWS,
    SETTLED,
    STAND_IN,
    by_row,
    concatenated,
    meet,
    named,
    names_of,
    packed,
    probes,
    shortly_identified,
    unpacked,
)
from keyfold.llm.substrings import covered

WINDOW = 200
GRAM = 64
CELL = 16
SEGMENT = 1 << 17  # starts looked at together; longer texts go in overlapping segments
WHOLE, OPEN = 0, 1

CELL_ROWS = StructType([*ROWS.fields[:2], StructField("whole", LongType(), False), *ROWS.fields[2:]])


@dataclass
class Runs:
    """Windows grouped by the gram they are looked up at: ``row`` and ``gram`` place in its text, windows
    ``first`` to ``last``, and the same places in ``ids``."""

    row: np.ndarray
    gram: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side, long ones cut: ``buffer``, and of each segment the text and where its first byte
    lies in it, as rows of (text, place in text, begin, end in buffer)."""
    cut = [
        (row, at, text[at : at + SEGMENT + WINDOW - 1])
        for row, text in enumerate(texts)
        for at in range(0, max(1, len(text) - WINDOW + 1), SEGMENT)
        if len(text) >= WINDOW
    ]
    for start, end in slices(np.array([len(s) for _, _, s in cut]), SEGMENT):
        some = cut[start:end]
        sizes = np.array([len(s) for _, _, s in some])
        begins = np.cumsum(sizes) - sizes
        buffer = np.frombuffer(b"".join(s for _, _, s in some), np.uint8)
        yield buffer, np.array([(row, at) for row, at, _ in some]), np.stack((begins, begins + sizes), axis=1)


def gram_runs(buffer: np.ndarray, names: np.ndarray, bounds: np.ndarray, levels: dict[int, np.ndarray]) -> Runs:
    """The windows of some segments by the gram each is looked up at."""
    grams = levels[GRAM]
    windows = np.concatenate([np.arange(b, e - WINDOW + 1) for b, e in bounds])
    chosen = least_ahead(grams, WINDOW - GRAM + 1)[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = chosen[1:] != chosen[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    segment = np.searchsorted(bounds[:, 0], windows[first], side="right") - 1
    shift = names[segment, 1] - bounds[segment, 0]
    return Runs(names[segment, 0], chosen[first] + shift, windows[first] + shift, windows[last] + shift, grams[chosen[first]])


def grams(rows: DataFrame) -> DataFrame:
    """Round 1: the grams at which the windows of every row are looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = names_of(batch)
            before = (-1, -1)  # a gram chosen on both sides of a cut is one place
            some = encoded_slices(batch.column("text"))
            for start, (buffer, names, bounds) in ((start, s) for start, texts in some for s in segments(texts)):
                runs = gram_runs(buffer, names, bounds, powers(BYTE_HASH[buffer], GRAM))
                runs.row += start
                once = np.ones(len(runs.row), dtype=bool)
                once[1:] = (runs.row[1:] != runs.row[:-1]) | (runs.gram[1:] != runs.gram[:-1])
                once[0] = before != (runs.row[0], runs.gram[0])
                before = (runs.row[-1], runs.gram[-1])
                row, gram, key = runs.row[once], runs.gram[once], runs.key[once]
                yield probes(key, np.zeros(len(key), np.uint32), doc[row], part[row], gram, later=False)

    return rows.select(*NAME, "text").mapInArrow(run, ROWS)


def _two_levels(buffer: np.ndarray) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    ids = BYTE_HASH[buffer]
    return powers(ids, 128), powers(scramble(ids), 128)


def _texts(batch: pa.RecordBatch, *lists: str) -> Iterator[tuple]:
    """A batch in slices: texts, ``doc``, ``part`` and lists."""
    doc, part = names_of(batch)
    columns = [batch.column(c).to_pylist() for c in lists]
    sizes = np.array([len(x) for x in batch.column("packed").to_pylist()])
    for start, end in slices(2 * sizes):
        texts = unpacked(batch.column("packed").slice(start, end - start))
        yield texts, doc[start:end], part[start:end], *(c[start:end] for c in columns)


def cells(rows: DataFrame) -> DataFrame:
    """Round 2: the cells of the windows at the grams ``shared``, of packed rows. A cell's place is its
    first window and the number of its windows less one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, doc, part, shared in _texts(batch, "shared"):
                wanted = _pairs(shared)
                for buffer, names, bounds in segments(texts):
                    levels, second = _two_levels(buffer)
                    runs = gram_runs(buffer, names, bounds, levels)
                    held = np.isin(_pair(runs.row, runs.gram), wanted)
                    row, gram, first, last = (a[held] for a in (runs.row, runs.gram, runs.first, runs.last))
                    # cells count from the gram backwards, so equal windows are in equal cells
                    low, high = (gram - last) // CELL, (gram - first) // CELL
                    number = high - low + 1
                    cell = np.repeat(low, number) + count_up(number)
                    row, gram, first, last = (np.repeat(a, number) for a in (row, gram, first, last))
                    begin = np.maximum(first, gram - (cell + 1) * CELL + 1)
                    end = np.minimum(last, gram - cell * CELL)
                    segment = np.searchsorted(_pair(names[:, 0], names[:, 1]), _pair(row, begin), side="right") - 1
                    shift = bounds[segment, 0] - names[segment, 1]
                    # what all windows of an uncut cell share, whichever of them are here
                    common = gram - cell * CELL + shift
                    size = np.full(len(row), WINDOW - CELL + 1)
                    yield _cell_probes(
                        span_ids(levels, common, size, 128),
                        span_ids(second, common, size, 128),
                        span_ids(levels, begin + shift, end - begin + WINDOW, 128),
                        doc[row],
                        part[row],
                        begin << 5 | (end - begin),
                    )

    return rows.select(*NAME, "doc_id", "packed", "shared").mapInArrow(run, CELL_ROWS)


def _cell_probes(k1, k2, whole, doc, part, place) -> pa.RecordBatch:
    """The rows one batch sends: cells equal as a whole are settled here, and one of them stands in."""
    k2 = k2.astype(np.uint32)
    order = np.lexsort((whole, k2, k1))
    k1, k2, whole, doc, part, place = (a[order] for a in (k1, k2, whole, doc, part, place))
    new = np.ones(len(k1), dtype=bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    several = np.diff(np.append(first, len(k1))) > 1
    settled = several[np.cumsum(new) - 1]
    stand_in = first[several]
    key = k1.copy()
    key[settled] = scramble(doc[settled].view(np.uint64) ^ scramble(place[settled].view(np.uint64)))
    mark = place << 2 | np.where(settled, SETTLED, PROBE)
    columns = [
        (key.view(np.int64), k1.view(np.int64)),
        (k2.view(np.int32), k2.view(np.int32)),
        (whole.view(np.int64), whole.view(np.int64)),
        (doc, doc),
        (part, part),
        (mark, place << 2 | STAND_IN),
    ]
    *keys, doc, part, mark = (np.concatenate((own, other[stand_in])) for own, other in columns)
    return pa.RecordBatch.from_arrays([*(pa.array(k) for k in keys), *named(doc, part), pa.array(mark)], names=CELL_ROWS.names)


def meet_cells(rows: DataFrame) -> DataFrame:
    """``doc, part, more, place`` of the cells of which something stands elsewhere; the place says which cell and whether
    it is repeated as a whole or its windows have to be looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = kind_of = None  # where the batch before ended
        alone = leader = None  # its last cell if met once so far; the first of the last bucket's only kind
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, whole, mark = (batch.column(c).to_numpy() for c in ("k1", "k2", "whole", "mark"))
            doc, part = names_of(batch)
            settled = mark & 3 == SETTLED
            place = mark >> 2 << 1
            out = [(doc[settled], part[settled], place[settled] | WHOLE)]
            k1, k2, whole, doc, part, place, mark = (a[~settled] for a in (k1, k2, whole, doc, part, place, mark))
            if len(k1):
                turn = np.ones(len(k1), dtype=bool)
                turn[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
                new = turn.copy()
                new[1:] |= whole[1:] != whole[:-1]
                same_bucket = bucket == (k1[0], k2[0])
                same_kind = same_bucket and kind_of == whole[0]
                first = np.flatnonzero(new)  # of each kind of cell
                probe = mark & 3 == PROBE
                several = (np.diff(np.append(first, len(k1))) > 1) | ~probe[first]
                if same_kind:
                    several[0] = True
                    if alone:
                        out.append(_one(alone, WHOLE))
                repeated = several[np.cumsum(new) - 1] & probe
                out.append((doc[repeated], part[repeated], place[repeated] | WHOLE))
                # kinds in each bucket, the one before the batch included
                start = np.flatnonzero(turn[first])
                kinds = np.diff(np.append(start, len(first)))
                kinds[0] += same_bucket and not same_kind
                lead = first[np.repeat(kinds > 1, np.diff(np.append(start, len(first))))]
                if same_bucket:
                    if leader is None:
                        # the bucket was mixed before: every kind new to it is looked at
                        lead = np.union1d(lead, first[: np.diff(np.append(start, len(first)))[0]])
                    elif kinds[0] > 1:
                        out.append(_one(leader, OPEN))
                    if same_kind:
                        lead = lead[lead != 0]
                out.append((doc[lead], part[lead], place[lead] | OPEN))
                if len(start) > 1 or not same_bucket:
                    at = first[start[-1]]
                    leader = (doc[at], part[at], place[at]) if kinds[-1] == 1 else None
                elif kinds[-1] > 1:
                    leader = None
                at = first[-1]
                alone = (doc[at], part[at], place[at]) if not several[-1] else None
                bucket, kind_of = (k1[-1], k2[-1]), whole[-1]
            doc, part, place = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([*named(doc, part), pa.array(place)], names=PLACES.names)

    together = rows.repartition("k1").sortWithinPartitions("k1", "k2", "whole")
    return together.mapInArrow(run, PLACES)


def _one(cell: tuple, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array([cell[0]], np.int64), np.array([cell[1]], PART), np.array([cell[2] | state], np.int64)


def _pair(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    return row.astype(np.int64) << 40 | place


def _pairs(lists: list) -> np.ndarray:
    places, counts = concatenated(lists)
    return _pair(np.repeat(np.arange(len(lists)), counts), places)


def open_windows(row: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of the cells that have to be looked at."""
    open_ = places & 1 == OPEN
    row, cell = row[open_], places[open_] >> 1
    number = (cell & 31) + 1
    pairs = np.unique(_pair(np.repeat(row, number), np.repeat(cell >> 5, number) + count_up(number)))
    return pairs >> 40, pairs & ((1 << 40) - 1)


def single_windows(rows: DataFrame) -> DataFrame:
    """Round 3: the windows of the open cells among ``refined``, of packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, doc, part, lists in _texts(batch, "refined"):
                places, counts = concatenated(lists)
                row, window = open_windows(np.repeat(np.arange(len(lists)), counts), places)
                todo = _pair(row, window)
                for buffer, names, bounds in segments(texts):
                    pairs = _pair(names[:, 0], names[:, 1])
                    # of the segments that hold a window, the one it begins in
                    segment = np.searchsorted(pairs, todo, side="right") - 1
                    here = (segment >= 0) & (names[segment, 0] == row) & (window - names[segment, 1] < SEGMENT)
                    if not here.any():
                        continue
                    at = window[here] + bounds[segment[here], 0] - names[segment[here], 1]
                    levels, second = _two_levels(buffer)
                    size = np.full(len(at), WINDOW)
                    k1, k2 = span_ids(levels, at, size, 128), span_ids(second, at, size, 128)
                    yield probes(k1, k2, doc[row[here]], part[row[here]], window[here], later=False)

    return rows.select(*NAME, "doc_id", "packed", "refined").mapInArrow(run, ROWS)


def removed(size: int, cells_: list[int] | None, singles: list[int] | None) -> np.ndarray | None:
    """Which bytes of a text go; None for none."""
    places = np.array(cells_ or [], np.int64)
    cell = places[places & 1 == WHOLE] >> 1
    number = (cell & 31) + 1
    starts = np.repeat(cell >> 5, number) + count_up(number)
    return covered(size, [*starts.tolist(), *(singles or [])], WINDOW)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row of ``docs``, texts in UTF-8.

    A byte goes when a string of ``WINDOW`` bytes over it also starts anywhere else, in the same text or
    another, judged on the texts as they came; all copies go. A repeated row is a place of its own. ``doc_id``
    is integral or null; a null or empty text has no bytes; other columns are ignored; an empty table
    gives no rows.
    """
    rows, key = shortly_identified(docs), NAME
    texts = packed(rows)
    shared = by_row(meet(grams(rows), later=False), "shared")
    refined_ = by_row(meet_cells(cells(texts.join(shared, key))), "refined")
    found = by_row(meet(single_windows(texts.join(refined_, key)), later=False), "found")
    schema = schema_with(
        docs, ["doc_id"], "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts_, _, _, cells_, singles in _texts(batch, "refined", "found"):
                out = []
                for text, some, others in zip(texts_, cells_, singles):
                    gone = removed(len(text), some, others)
                    kept, spans = text, 0
                    if gone is not None:
                        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    out.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts_)), *columns], names=schema.names
                )
                at += len(texts_)

    whole = texts.join(refined_, key, "left").join(found, key, "left")
    return whole.select(*NAME, "doc_id", "packed", "refined", "found").mapInArrow(run, schema)
