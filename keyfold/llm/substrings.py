"""Substring dedup (operator 8): passages that stand in an earlier document, by difference-cover anchors.

A cover modulo ``PERIOD`` has for every two residues a shift that takes both into it. So if 50 words are the
same in two documents, some place among the first ``PERIOD`` is a cover position in both, whatever their
alignment, and the words from there to the window's end are hashed in both. Anchors that meet are extended to
the windows around them, and no others are compared.

Neighbouring windows are compared in cells first. A window belongs to the one of its runs of words that has the smallest
hash, so equal windows are in equal cells whatever surrounds them. A cell whose words stand in an earlier
document as a whole is done; where cells share words but are not equal, their windows are compared one by one,
those of the earliest cell of each kind standing for the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from keyfold.llm.common import (
    Words,
    count_up,
    encoded_slices,
    least_ahead,
    mix,
    run_ids,
    schema_with,
    scramble,
    slices,
)
from keyfold.llm.meeting import (
    NAME,
    PLACES,
    PROBE,
    ROWS,
    SETTLED,
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

WINDOW_WORDS = 50
# A perfect difference set, every residue being the difference of two of its members.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
CELL = 8
WHOLE, OPEN = 0, 1

CELL_ROWS = StructType([*ROWS.fields[:2], StructField("whole", LongType(), False), *ROWS.fields[2:]])


def anchors(rows: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The runs of words at cover positions of every row of :func:`meeting.identified`."""
    length = window - PERIOD + 1
    cover = np.isin(np.arange(PERIOD), COVER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = names_of(batch)
            for start, texts in encoded_slices(batch.column("text")):
                words = Words(texts)
                place = np.arange(len(words.text)) - words.bounds[words.text]
                size = np.diff(words.bounds)[words.text]
                at = np.flatnonzero(cover[place % PERIOD] & (words.to_end() >= length) & (size >= window))
                keys = run_ids(words.hashes, [length])[length][at]
                row = words.text[at] + start
                yield probes(keys, np.zeros(len(at), np.uint32), doc[row], part[row], place[at], later=False)

    return rows.select(*NAME, "text").mapInArrow(run, ROWS)


def _packed_slices(batch: pa.RecordBatch, lists: str) -> Iterator[tuple]:
    """A batch in slices: words, ``doc`` and ``part`` of each text, and a list for each."""
    doc, part = names_of(batch)
    entries = batch.column(lists).to_pylist()
    sizes = np.array([len(x) for x in batch.column("packed").to_pylist()])
    for start, end in slices(2 * sizes):
        words = Words(unpacked(batch.column("packed").slice(start, end - start)))
        yield words, doc[start:end], part[start:end], entries[start:end]


def cells(rows: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The cells of the windows that hold an anchor among ``anchored``, of packed rows. A cell's place is its first
    window and the number of its windows less one."""
    gram, shared = window - PERIOD + 1, window - CELL + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, doc, part, anchored in _packed_slices(batch, "anchored"):
                places, counts = concatenated(anchored)
                first = words.bounds[:-1].repeat(counts)
                held = np.zeros(len(words.text) + 1, np.int64)
                np.add.at(held, np.maximum(places - (PERIOD - 1), 0) + first, 1)
                np.add.at(held, places + first + 1, -1)
                at = np.flatnonzero((np.cumsum(held)[:-1] > 0) & (words.to_end() >= window))
                ids = run_ids(words.hashes, [gram, shared, window])
                chosen = least_ahead(ids[gram], PERIOD)[at]
                cell = (chosen - at) // CELL
                new = np.ones(len(at), dtype=bool)
                new[1:] = (chosen[1:] != chosen[:-1]) | (cell[1:] != cell[:-1]) | (at[1:] != at[:-1] + 1)
                starts = np.flatnonzero(new)
                begin, end = at[starts], at[np.append(starts[1:], len(at)) - 1]
                # what all windows of an uncut cell share, whichever of them are here
                common = chosen[starts] - cell[starts] * CELL
                second = run_ids(scramble(words.hashes), [shared])[shared]
                text = words.text[begin]
                yield _cell_probes(
                    ids[shared][common],
                    second[common],
                    # the first and the last window overlap, so they hold all words of the cell
                    mix(ids[window][begin], ids[window][end] + (end - begin).astype(np.uint64)),
                    doc[text],
                    part[text],
                    (begin - words.bounds[text]) << 3 | (end - begin),
                )

    return rows.select(*NAME, "doc_id", "packed", "anchored").mapInArrow(run, CELL_ROWS)


def _cell_probes(k1, k2, whole, doc, part, place) -> pa.RecordBatch:
    """The rows one batch sends: a cell that stands in an earlier document of the batch is settled here."""
    k2 = k2.astype(np.uint32)
    order = np.lexsort((doc, whole, k2, k1))
    k1, k2, whole, doc, part, place = (a[order] for a in (k1, k2, whole, doc, part, place))
    new = np.ones(len(k1), dtype=bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (whole[1:] != whole[:-1])
    settled = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    key = k1.copy()
    key[settled] = scramble(doc[settled].view(np.uint64) ^ scramble(place[settled].view(np.uint64)))
    keys = key.view(np.int64), k2.view(np.int32), whole.view(np.int64)
    mark = place << 2 | np.where(settled, SETTLED, PROBE)
    return pa.RecordBatch.from_arrays([*(pa.array(k) for k in keys), *named(doc, part), pa.array(mark)], names=CELL_ROWS.names)


def meet_cells(rows: DataFrame) -> DataFrame:
    """``doc, part, more, place`` of the cells that stand in an earlier document as a whole (``WHOLE``), and of those
    whose windows have to be looked at (``OPEN``): the earliest of each kind where a bucket holds several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = kind = earliest = None  # where the batch before ended
        mixed = False  # whether its last bucket holds several kinds
        waiting: list[np.ndarray] = []  # the earliest cells of its only kind, else none
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, whole, mark = (batch.column(c).to_numpy() for c in ("k1", "k2", "whole", "mark"))
            settled = mark & 3 == SETTLED
            doc, *rest = (batch.column(c).to_numpy() for c in NAME)
            cell = np.stack((doc, *rest, mark >> 2 << 1))
            out = [cell[:, settled]]
            at = np.flatnonzero(~settled)
            if len(at):
                k1, k2, whole, doc, cell = k1[at], k2[at], whole[at], doc[at], cell[:, at]
                turn = np.ones(len(at), dtype=bool)
                turn[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
                new = turn.copy()
                new[1:] |= whole[1:] != whole[:-1]
                same_bucket = bucket == (k1[0], k2[0])
                same_kind = same_bucket and kind == whole[0]
                first = doc[np.flatnonzero(new)]
                if same_kind:
                    first[0] = earliest
                lead = doc == first[np.cumsum(new) - 1]
                out.append(cell[:, ~lead])
                which = np.cumsum(turn) - 1
                several = np.bincount(which, weights=new) > 1
                if same_bucket:
                    several[0] |= mixed or not same_kind
                    if several[0]:
                        out += [w | _OPEN_MARK for w in waiting]
                        waiting = []
                out.append(cell[:, lead & several[which]] | _OPEN_MARK)
                if which[-1] or not same_bucket:
                    waiting = []
                if not several[-1]:
                    waiting.append(cell[:, lead & (which == which[-1])])
                mixed = bool(several[-1])
                bucket, kind, earliest = (k1[-1], k2[-1]), whole[-1], first[-1]
            found = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=PLACES.names)

    together = rows.repartition("k1").sortWithinPartitions("k1", "k2", "whole", "doc")
    return together.mapInArrow(run, PLACES)


_OPEN_MARK = np.array([[0], [0], [0], [OPEN]], np.int64)


def windows_of(places: np.ndarray, state: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of the cells of one kind, and which of the places each is from."""
    of = np.flatnonzero(places & 1 == state)
    cell = places[of] >> 1
    number = (cell & 7) + 1
    return np.repeat(cell >> 3, number) + count_up(number), np.repeat(of, number)


def open_windows(rows: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The windows of the open cells among ``refined``, of packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, doc, part, refined in _packed_slices(batch, "refined"):
                places, counts = concatenated(refined)
                window_, of = windows_of(places, OPEN)
                text = np.repeat(np.arange(len(refined)), counts)[of]
                at = np.unique(window_ + words.bounds[text])
                k1 = run_ids(words.hashes, [window])[window][at]
                k2 = run_ids(scramble(words.hashes), [window])[window][at]
                text = words.text[at]
                yield probes(k1, k2, doc[text], part[text], at - words.bounds[text], later=True)

    return rows.select(*NAME, "doc_id", "packed", "refined").mapInArrow(run, ROWS)


def covered(size: int, starts: list[int] | None, length: int) -> np.ndarray | None:
    """Which of ``size`` places the windows at ``starts`` cover; None for no window."""
    if not starts:
        return None
    at = np.array(starts, np.int64)
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, np.minimum(at + length, size), -1)
    return np.cumsum(edges)[:-1] > 0


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every row of ``docs``, ``kept`` being the words that
    stay, joined by blanks.

    A word goes when a window of ``window`` words over it also starts in a row with a smaller ``doc_id``, judged on
    the texts as they came. ``doc_id`` is integral; null stands behind all others; rows that share one do
    not count against each other. A null or empty text has no words; other columns are ignored; an
    empty table gives no rows. ``window`` is above the period of the cover.
    """
    if window <= PERIOD:
        raise ValueError(f"windows have more than {PERIOD} words")
    rows, key = shortly_identified(docs), NAME
    texts = packed(rows)
    anchored = by_row(meet(anchors(rows, window), later=False), "anchored")
    refined = by_row(meet_cells(cells(texts.join(anchored, key), window)), "refined")
    found = by_row(meet(open_windows(texts.join(refined, key), window), later=True), "found")
    schema = schema_with(docs, ["doc_id"], "n_words bigint, n_removed bigint, kept_sha256 string, kept binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells_, starts = batch.column("refined").to_pylist(), batch.column("found").to_pylist()
            sizes = np.array([len(x) for x in batch.column("packed").to_pylist()])
            for begin, end in slices(2 * sizes):
                out = []
                texts_ = unpacked(batch.column("packed").slice(begin, end - begin))
                for text, some, others in zip(texts_, cells_[begin:end], starts[begin:end]):
                    words = text.split()
                    whole, _ = windows_of(np.array(some or [], np.int64), WHOLE)
                    gone = covered(len(words), [*whole.tolist(), *(others or [])], window)
                    kept = words if gone is None else list(compress(words, (~gone).tolist()))
                    joined = b" ".join(kept)
                    out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined))
                columns = zip(*out)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=schema.names,
                )

    whole = texts.join(refined, key, "left").join(found, key, "left")
    return whole.select(*key, "doc_id", "packed", "refined", "found").mapInArrow(run, schema)
