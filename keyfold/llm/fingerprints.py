"""Document fingerprints (operator 6): bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct hashes of a text's word shingles, as hexadecimal digits in ascending
order. With fewer than ``k`` it is the whole set. Sketches of parts merge into the sketch of the whole,
and from two of them follow resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import Words, run_ids, schema_with, scramble, slices

SKETCH_SIZE = 128
SHINGLE_WORDS = 5
# Ids looked at to choose where ranges of documents begin; the ranges hold all documents whatever the sample.
BOUNDARY_SAMPLE = 20_000
_RANGE = float(2**64)


def shingle_hashes(texts: list[bytes], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Hashes of each text's shingles in order; a shorter text is one shingle, an empty one none."""
    found = Words(texts)
    ids = run_ids(found.hashes, list(range(1, words + 1)))
    whole = scramble(ids[words])
    out = []
    for start, end in zip(found.bounds[:-1], found.bounds[1:]):
        if end - start >= words:
            out.append(whole[start : end - words + 1])
        elif end > start:
            out.append(scramble(ids[int(end - start)][start : start + 1]))
        else:
            out.append(whole[:0])
    return out


def sketch(hashes: np.ndarray, k: int = SKETCH_SIZE) -> np.ndarray:
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> np.ndarray:
    """The sketch of two parts together."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Number of distinct shingles: exact below ``k``, else from how densely the hashes lie."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1.0) / _RANGE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Share of common shingles among all of both texts; 1 for two empty texts, 0 for one."""
    if not len(a) and not len(b):
        return 1.0
    both = merged(a, b, k)
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, common, assume_unique=True).sum()) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Share of the first text's shingles that the second has too; 1 for an empty first text."""
    if not len(a):
        return 1.0
    alike, first, second = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return min(1.0, alike / (1.0 + alike) * (first + second) / first)


def to_text(a: np.ndarray) -> str:
    return a.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint, distinct_shingles`` of every row of ``docs``.

    A null text counts as empty and has the empty fingerprint; repeated rows come out again; a null ``doc_id``
    stays null; other columns are ignored; an empty table gives no rows.
    """
    schema = schema_with(docs, ["doc_id"], "fingerprint string, distinct_shingles double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            sketches = []
            for start, end in slices(np.array([len(t) for t in texts])):
                sketches += [sketch(h, k) for h in shingle_hashes(texts[start:end], words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([to_text(s) for s in sketches], pa.string()),
                    pa.array([distinct_count(s, k) for s in sketches], pa.float64()),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def merged_fingerprints(rows: DataFrame, by: str, k: int = SKETCH_SIZE) -> DataFrame:
    """The fingerprint of each group of ``rows`` (``by``, ``fingerprint``). Batches are folded before they
    are shuffled, so a group sends one sketch a batch, and merging holds one sketch a group."""
    schema = schema_with(rows, [by], "fingerprint string")

    def fold(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        for batch in batches:
            for key, text in zip(batch.column(by).to_pylist(), batch.column("fingerprint").to_pylist()):
                groups[key] = merged(groups.get(key, np.zeros(0, np.uint64)), from_text(text or ""), k)
            if not whole:
                yield as_batch(groups, batch)
                groups = {}
        if whole and groups:
            yield as_batch(groups, batch)

    def as_batch(groups: dict, like: pa.RecordBatch) -> pa.RecordBatch:
        keys = pa.array(list(groups), like.column(by).type)
        return pa.RecordBatch.from_arrays([keys, pa.array([to_text(s) for s in groups.values()], pa.string())], names=schema.names)

    partial = rows.select(by, "fingerprint").mapInArrow(lambda b: fold(b, False), schema)
    return partial.repartition(by).mapInArrow(lambda b: fold(b, True), schema)


def with_successors(docs: DataFrame, parts: int) -> DataFrame:
    """``doc_id, text, part, tail``: documents cut into ranges of ascending ``doc_id`` (null last), each
    range followed by a copy of the first document after it (``tail``), the last by the very first.

    Ranges begin at ids drawn from a bounded sample, so the first document of each is known without
    looking for it, and every document goes to one range and at most one more place.
    """
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    count, first = ids.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    share = min(1.0, BOUNDARY_SAMPLE / max(count, 1))
    drawn = sorted({r[0] for r in ids.sample(share, 7).take(2 * BOUNDARY_SAMPLE)} - {first})
    starts = sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)}) if drawn else []
    schema = schema_with(docs, ["doc_id"], "text string, part int, tail boolean")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, part, tail = [], [], []
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = len(starts) if doc_id is None else bisect_right(starts, doc_id)
                rows.append(row)
                part.append(own)
                tail.append(False)
                if doc_id == first or (doc_id is not None and own and starts[own - 1] == doc_id):
                    rows.append(row)
                    part.append(len(starts) if doc_id == first else own - 1)
                    tail.append(True)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    batch.column("text").take(taken),
                    pa.array(part, pa.int32()),
                    pa.array(tail, pa.bool_()),
                ],
                names=schema.names,
            )

    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(assign, schema)
    return whole.repartition("part").sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_last(), "text")


def edited(text: str, following: str) -> str:
    """The last half of a text's code points replaced by as many of the first of another's."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbour_likeness(docs: DataFrame, parts: int, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """Every document's fingerprint against its edited text's and against the next document's, next by
    ascending ``doc_id``.

    A null text counts as empty. Rows with a null ``doc_id`` come last; rows that share one follow each
    other by text. Of the last row the next is the first, of a single row itself. Other columns are
    ignored; an empty table gives no rows.
    """
    schema = schema_with(
        docs,
        ["doc_id"],
        "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row waits for the next batch
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "tail")))
            for start, end in slices(np.array([len(t[1]) for t in held[:-1]])):
                yield compare(held[start : end + 1], batch.column("doc_id").type)
            held = held[-1:]

    def compare(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        texts = [r[1] for r in rows]
        pairs = [i for i in range(len(rows) - 1) if not rows[i][3]]
        changed = [edited(texts[i], texts[i + 1]).encode() for i in pairs]
        own = [sketch(h, k) for h in shingle_hashes([t.encode() for t in texts], words)]
        new = [sketch(h, k) for h in shingle_hashes(changed, words)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][0] for i in pairs], id_type),
                pa.array([len(texts[i]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
                pa.array([to_text(own[i]) for i in pairs], pa.string()),
                pa.array([to_text(s) for s in new], pa.string()),
                pa.array([resemblance(own[i], s, k) for i, s in zip(pairs, new)], pa.float64()),
                pa.array([resemblance(own[i], own[i + 1], k) for i in pairs], pa.float64()),
            ],
            names=schema.names,
        )

    return with_successors(docs, parts).mapInArrow(run, schema)
